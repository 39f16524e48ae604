"""Queries of the operators over their whole tables: name -> (query, DuckDB SQL or None).

Each query derives its digest columns from the operator's own output."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from carespark.llm import (bpe, chat, exact_dedup, filter_audit, fingerprints, jaccard, line_dedup, manifest, packing, pieces, quality,
                           secrets, toxicity)
from carespark.llm.common import read_table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_packing(spark, sf_dir):
    """All documents packed into windows of 2048 tokens: a row for each piece."""
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), TOKENIZER, digests=True)


def op2_fingerprints(spark, sf_dir):
    """Order MinHash of every document, of its edited form, and their likeness."""
    return fingerprints.fingerprint_documents(read_table(spark, sf_dir, "documents"))


def op3_secrets(spark, sf_dir):
    """Secrets and linked credential parts of every document."""
    return secrets.scan_secrets(read_table(spark, sf_dir, "documents"))


def _op3_matches() -> str:
    rows = []
    for n, (kind, pattern) in enumerate(secrets.KINDS):
        p = pattern.replace("'", "''")
        ok = {"assign": f"length(regexp_extract(hit, '{p}', 2)) >= {secrets.ASSIGN_VALUE}",
              "weak": "regexp_matches(hit, '[0-9][^0-9]*[0-9]') AND regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[A-Z]')"}
        rows.append(f"""
    SELECT uid, {n} AS kind, stop - length(hit) AS start, stop, ({ok.get(kind, 'true')}) AS ok FROM (
        SELECT uid, hit, sum(length(gap) + length(hit)) OVER (PARTITION BY uid ORDER BY place) AS stop FROM (
            SELECT uid, unnest(h) AS hit, unnest(g[1:len(h)]) AS gap, generate_subscripts(h, 1) AS place FROM (
                SELECT uid, regexp_extract_all(t, '{p}', 0) AS h, string_split_regex(t, '{p}') AS g FROM d)))""")
    return "\n    UNION ALL".join(rows)


# The same scopes and links by a self-join on the gap between intervals.
OP3_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS t FROM documents),
found AS MATERIALIZED (SELECT uid, kind, start, stop FROM ({_op3_matches()}) WHERE ok),
parts AS MATERIALIZED (
    SELECT f.*, (SELECT count(*) FROM found b WHERE b.uid = f.uid AND b.kind = 6 AND b.start < f.start) AS scope
    FROM found f
    WHERE f.kind < 6 AND NOT (f.kind = 4 AND EXISTS (
        SELECT 1 FROM found s WHERE s.uid = f.uid AND s.kind < 3 AND s.start < f.stop AND s.stop > f.start))
),
near AS (
    SELECT a.uid, a.kind, a.start, a.stop, bool_or(b.kind IN (1, 3)) AS ids, bool_or(b.kind IN (0, 2, 4)) AS secrets,
           bool_or(b.kind = 5) AS endpoints
    FROM parts a JOIN parts b ON a.uid = b.uid AND a.scope = b.scope
        AND greatest(a.start, b.start) - least(a.stop, b.stop) <= {secrets.SCOPE_CHARS}
    GROUP BY ALL
),
kept AS (
    SELECT *, ['assign', 'access', 'hex', 'ident', 'weak', 'endpoint'][kind + 1] || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS s
    FROM near
    WHERE kind < 3 OR (kind = 3 AND secrets) OR (kind = 4 AND (ids OR endpoints)) OR (kind = 5 AND ids AND secrets)
)
SELECT any_value(d.doc_id) AS doc_id,
       count(*) FILTER (WHERE kind = 0) AS n_assign,
       count(*) FILTER (WHERE kind = 1) AS n_access,
       count(*) FILTER (WHERE kind = 2) AS n_hex,
       sha256(coalesce(string_agg(s, ',' ORDER BY start, kind) FILTER (WHERE kind < 3), '')) AS base_sha256,
       coalesce(string_agg(s, ',' ORDER BY start, kind), '') AS spans
FROM d LEFT JOIN kept USING (uid)
GROUP BY uid
"""


def op4_toxicity(spark, sf_dir):
    """Toxicity of every document, with its offending sentences."""
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_exact_dedup(spark, sf_dir):
    """Every document with the row that stays of its group of equal texts."""
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
)
SELECT doc_id,
       min(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id) = 1 AS kept,
       sha256(body) AS text_sha256
FROM d
WINDOW g AS (PARTITION BY body)
"""


def op6_line_dedup(spark, sf_dir):
    """Every document without the long lines that many documents share."""
    return line_dedup.drop_shared_lines(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH lines AS (
    SELECT uid, doc_id, place, line,
           translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (
        SELECT uid, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place
        FROM (SELECT row_number() OVER () AS uid, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
    )
),
shared AS (
    SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
marked AS (
    SELECT l.*, s.key IS NOT NULL AND l.doc_id <> s.last AS gone FROM lines l LEFT JOIN shared s USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY uid
"""


def op7_quality(spark, sf_dir):
    """Quality of every document."""
    return quality.quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_chat(spark, sf_dir):
    """All conversations formatted, then read back from the formatted text."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = F.lit("</s>[INST] ok [/INST]").alias("text")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), probe)
    record = F.to_json(F.struct("conv_id", "turn", "role", "text"), {"ignoreNullFields": "false"})
    turns = chat.canonical_turns(rows.unionByName(more).select(F.col("conv_id").alias("key"), record.alias("record")))
    return chat.read_back(chat.format_conversations(turns))


def op9_bpe(spark, sf_dir):
    """Token ids and decoded text of every document, as digests."""
    return bpe.encode_documents(read_table(spark, sf_dir, "documents"), TOKENIZER, digests=True)


def op10_jaccard(spark, sf_dir):
    """Components of documents whose sets of 3-word shingles have a Jaccard likeness of 0.9 or more."""
    return jaccard.jaccard_components(read_table(spark, sf_dir, "documents"), words=3, percent=90)


def op11_filter_audit(spark, sf_dir):
    """What each of five filters removes from each language, in each of the 120 orders."""
    return filter_audit.audit_filters(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


# Every order counted from the cells themselves: a cell is kept by a prefix if it fails none of its filters.
OP11_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(CAST(lang AS VARCHAR), '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
    FROM documents
),
marks AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
),
cells AS MATERIALIZED (
    SELECT part,
           (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
           + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
           + 8 * regexp_matches(t, '[#$%&*|]')::INT
           + 16 * coalesce(first_id < doc_id, first_id IS NOT NULL)::INT AS mask,
           count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
    FROM d LEFT JOIN marks USING (doc_id) GROUP BY ALL
),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(l, b)),
orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
    FROM letters a JOIN letters b ON a.l <> b.l JOIN letters c ON c.l NOT IN (a.l, b.l)
    JOIN letters d ON d.l NOT IN (a.l, b.l, c.l) JOIN letters e ON e.l NOT IN (a.l, b.l, c.l, d.l)
),
steps AS (
    SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
    FROM orders, unnest([1, 2, 3, 4, 5]) AS u(step)
),
counted AS (
    SELECT part, filter_order, step, bit,
           coalesce(sum(n) FILTER (WHERE mask & (before + bit) = 0), 0) AS kept,
           coalesce(sum(n) FILTER (WHERE mask & before = 0 AND mask & bit <> 0), 0) AS removed,
           coalesce(sum(n) FILTER (WHERE mask & before <> 0 AND mask & bit <> 0), 0) AS redundant,
           coalesce(sum(n) FILTER (WHERE mask = bit), 0) AS unique_fails,
           coalesce(sum(good) FILTER (WHERE mask & before = 0 AND mask & bit <> 0), 0) AS good_lost,
           coalesce(sum(toxic) FILTER (WHERE mask & before = 0 AND mask & bit <> 0), 0) AS toxic_lost
    FROM cells, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
"""


def op12_sentencepiece(spark, sf_dir):
    """Piece ids and decoded text of every document, as digests."""
    return pieces.encode_pieces(read_table(spark, sf_dir, "documents"), PIECE_MODEL, digests=True)


def op13_merkle_manifest(spark, sf_dir):
    """Leaf, roots and proof of every document, and the root that a changed fifth gives."""
    return manifest.manifest(read_table(spark, sf_dir, "documents"))


def _op13_levels(nodes: str, levels: int, name: str) -> str:
    """CTEs of the nodes and runs of ``levels`` levels above (key, p, n, h) rows."""
    out, here = [], nodes
    for k in range(levels):
        runs, above = f"{name}_runs{k}", f"{name}{k + 1}"
        out.append(f"""
{runs} AS MATERIALIZED (SELECT key, p // 16 AS run, n, string_agg(h, '' ORDER BY p) AS s FROM {here} WHERE n > 1 GROUP BY key, run, n),
{above} AS MATERIALIZED (SELECT key, run AS p, (n + 15) // 16 AS n, sha256(s) AS h FROM {runs} UNION ALL SELECT * FROM {here} WHERE n = 1),""")
        here = above
    return "".join(out)


def _op13_steps(rows: str, levels: int, name: str) -> str:
    """CTEs that carry (uid, key, p, n, h, proof) rows up those levels, by their siblings."""
    out, here = [], rows
    for k in range(levels):
        above = f"{name}_up{k + 1}"
        out.append(f"""
{above} AS (
    SELECT uid, d.key, p // 16 AS p, (d.n + 15) // 16 AS n, CASE WHEN s IS NULL THEN h ELSE sha256(l || h || r) END AS h,
           CASE WHEN s IS NULL THEN proof ELSE proof || l || r END AS proof
    FROM (SELECT d.*, s, s[1:64 * (p % 16)] AS l, s[64 * (p % 16) + 65:] AS r
          FROM {here} d LEFT JOIN {name}_runs{k} x ON x.key = d.key AND x.run = d.p // 16) d),""")
        here = above
    return "".join(out)


def _op13_field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"


def _op13_leaf(text: str) -> str:
    return f"sha256({' || '.join(_op13_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


# The tree level by level over single rows: six levels hold 16,777,216 leaves a source, three 4,096 sources.
# CRC-32 by bits: a table of 256 remainders, then byte by byte.
OP13_SQL = f"""
WITH crc_table AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) r(i)
),
docs AS MATERIALIZED (
    SELECT row_number() OVER () AS uid, doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) AS key, {_op13_leaf("text")} AS leaf,
           xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ord(x)::BIGINT)),
                           lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) % 5 = 0 AS touched,
           {_op13_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS lowered
    FROM documents, crc_table
),
s0 AS MATERIALIZED (
    SELECT uid, doc_id, key, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
           count(*) OVER (PARTITION BY key) AS n, leaf, CASE WHEN touched THEN lowered ELSE leaf END AS shown
    FROM docs
),
s_leaves AS (SELECT key, p, n, leaf AS h FROM s0),
{_op13_levels("s_leaves", 6, "s")}
t_leaves AS MATERIALIZED (SELECT 0 AS key, key - 1 AS p, (SELECT count(*) FROM s6) AS n, h FROM s6),
{_op13_levels("t_leaves", 3, "t")}
s_rows AS (SELECT uid, key, p, n, shown AS h, '' AS proof FROM s0),
{_op13_steps("s_rows", 6, "s")}
t_rows AS (SELECT uid, 0 AS key, key - 1 AS p, (SELECT count(*) FROM s6) AS n, h, proof FROM s_up6),
{_op13_steps("t_rows", 3, "t")}
result AS (SELECT * FROM t_up3)
SELECT s0.doc_id, s0.leaf, s6.h AS subroot, t3.h AS root, sha256(proof) AS proof_sha256, result.h AS folded_root, result.h = t3.h AS verified
FROM result JOIN s0 USING (uid) JOIN s6 ON s6.key = s0.key CROSS JOIN t3
"""


REGISTRY = {
    "op1_packing": (op1_packing, None),
    "op2_fingerprints": (op2_fingerprints, None),
    "op3_secrets": (op3_secrets, OP3_SQL),
    "op4_toxicity": (op4_toxicity, None),
    "op5_exact_dedup": (op5_exact_dedup, OP5_SQL),
    "op6_line_dedup": (op6_line_dedup, OP6_SQL),
    "op7_quality": (op7_quality, None),
    "op8_chat": (op8_chat, None),
    "op9_bpe": (op9_bpe, None),
    "op10_jaccard": (op10_jaccard, None),
    "op11_filter_audit": (op11_filter_audit, OP11_SQL),
    "op12_sentencepiece": (op12_sentencepiece, None),
    "op13_merkle_manifest": (op13_merkle_manifest, OP13_SQL),
}
