"""Secrets and multipart credentials, with DataFrame functions alone.

Matches of each pattern become rows (document, kind, start, end): splitting a
text at a pattern gives the lengths between matches, and a running sum turns
lengths into positions. Strong kinds are reported wherever they occur. Weak
kinds (identifiers, secret-like tokens, endpoints) say little alone; they are
joined with the parts near them, and reported only where complementary parts
co-occur in one scope. A scope is a block of text between blank lines; within it
intervals are joined that lie at most SCOPE_CHARS apart, from the end of the one
to the start of the next. Of those that start before a part, the one that ends
last is the nearest; of those that start after it, the one that starts first:
running extremes over each scope, in its order and in the reverse one, tell
whether a part of some kind is near. No pairs of parts are made, and the work
is linear in a document's matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SCOPE_CHARS = 200

# FIXED VALUES: the kinds and their patterns. Greedy runs of one class of at least n
# characters are the same as all its runs with shorter ones dropped; "assign" is
# not such a run, so its short values are dropped after matching.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
KINDS = [
    ("assign", ASSIGN),
    ("access", "AKIA[A-Z0-9]{14,}"),
    ("hex", "[0-9a-f]{16,}"),
    ("ident", r"""(?i)(?:user(?:_?name)?|login|client_?id|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""),
    ("weak", "[A-Za-z0-9+/_-]{20,}={0,2}"),
    ("endpoint", "(?i)(?:https?|ftp|postgres|mysql|mongodb|redis|amqp)://[!#-&(-;=?-~]{4,}"),
    ("break", r"\n[\x20\t]*\n"),
]
NAMES = [name for name, _ in KINDS]
STRONG = 3                      # the first kinds are reported in any case
IDENTIFIERS, SECRETS, ENDPOINTS, BREAK = (1, 3), (0, 2, 4), (5,), 6


def _accepted(kind: str, hit: Column) -> Column:
    if kind == "assign":
        return F.length(F.regexp_extract(hit, ASSIGN, 2)) >= ASSIGN_VALUE
    if kind == "weak":
        return hit.rlike("[0-9][^0-9]*[0-9]") & hit.rlike("[a-z]") & hit.rlike("[A-Z]")
    return F.lit(True)


def _matches(text: Column, number: int, kind: str, pattern: str, whole_row: str) -> Column:
    """Array of (row, kind, place, gap, size, ok): the matches' lengths and those of the texts before them."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"))
    return F.transform(
        F.filter(pairs, lambda p: p["hit"].isNotNull()),
        lambda p, i: F.struct(F.expr(f"cast(null as {whole_row})").alias("row"), F.lit(number).alias("kind"), i.alias("place"),
                              F.length(p["gap"]).cast("long").alias("gap"), F.length(p["hit"]).cast("long").alias("size"),
                              _accepted(kind, p["hit"]).alias("ok")))


FORWARD = ("start", "kind", "end")
SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def _backward() -> list[Column]:
    """FORWARD reversed: a frame that runs to the end of a partition would cost the square of its rows."""
    return [F.desc(c) for c in FORWARD]


def _near(kinds: tuple, scope) -> Column:
    """A part of these kinds lies at most SCOPE_CHARS from this one."""
    of_kind = F.col("kind").isin(*kinds)
    before = F.max(F.when(of_kind, F.col("end"))).over(scope.orderBy(*FORWARD).rowsBetween(*SO_FAR))
    after = F.min(F.when(of_kind, F.col("start"))).over(scope.orderBy(*_backward()).rowsBetween(*SO_FAR))
    return F.coalesce(F.col("start") - before <= SCOPE_CHARS, F.lit(False)) | F.coalesce(after - F.col("end") <= SCOPE_CHARS, F.lit(False))


def _spans(docs: DataFrame, whole: bool) -> DataFrame:
    """A row for each input row: (row, spans), spans being (start, kind, end, before), sorted; ``before``
    is the end of what earlier spans cover. ``row`` is the input row, or only its doc_id."""
    keep = F.struct(*(F.col(f"`{c}`") for c in (docs.columns if whole else ["doc_id"])))
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(keep.alias("row"), text.alias("text"), F.monotonically_increasing_id().alias("uid"))
    kind = d.schema["row"].dataType.simpleString() if not whole else None
    if whole:
        kind = "struct<" + ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in d.schema["row"].dataType) + ">"
    head = F.array(F.struct(F.col("row"), F.lit(-1).alias("kind"), F.lit(0).alias("place"), F.lit(0).cast("long").alias("gap"),
                            F.lit(0).cast("long").alias("size"), F.lit(True).alias("ok")))
    parts = F.concat(head, *(_matches(F.col("text"), n, k, p, kind) for n, (k, p) in enumerate(KINDS)))
    d = d.select("uid", F.explode(parts).alias("m")).select("uid", "m.*").repartition("uid")
    d = d.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("uid", "kind").orderBy("place")))
    d = d.withColumn("start", F.col("end") - F.col("size")).where("ok").select("uid", "row", "kind", "start", "end")
    # weak tokens that a strong span overlaps say nothing new
    by_start = Window.partitionBy("uid").orderBy(*FORWARD)
    by_end = Window.partitionBy("uid").orderBy(*_backward())
    strong = F.col("kind").between(0, STRONG - 1)
    d = d.withColumns({
        "strong_before": F.max(F.when(strong, F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, -1)),
        "strong_after": F.min(F.when(strong, F.col("start"))).over(by_end.rowsBetween(Window.unboundedPreceding, -1)),
        "scope": F.sum((F.col("kind") == BREAK).cast("int")).over(by_start),
    })
    d = d.where("kind != 4 or (coalesce(strong_before, 0) <= start and coalesce(strong_after, end) >= end)")
    scope = Window.partitionBy("uid", "scope")
    d = d.withColumns({"ids": _near(IDENTIFIERS, scope), "secrets": _near(SECRETS, scope), "endpoints": _near(ENDPOINTS, scope)})
    d = d.where("kind < 3 or (kind = 3 and secrets) or (kind = 4 and (ids or endpoints)) or (kind = 5 and ids and secrets)")
    d = d.withColumn("before", F.coalesce(F.max("end").over(
        Window.partitionBy("uid").orderBy(*FORWARD).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # the head's row by a list: first() would copy it at each of the group's rows
    return d.groupBy("uid").agg(
        F.get(F.collect_list("row"), F.lit(0)).alias("row"),
        F.sort_array(F.collect_list(F.when(F.col("kind") >= 0, F.struct("start", "kind", "end", "before")))).alias("spans"))


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, NAMES))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Secrets of every whole text.

    Returns a row for each input row: (doc_id, n_assign, n_access, n_hex,
    base_sha256, spans); spans are kind:start:end by start, in code points, end
    exclusive, joined by commas; base_sha256 digests those of the strong kinds. A
    null or empty text has none; a null doc_id stays null; repeated rows give
    repeated results; further columns are not read; an empty table gives none."""
    d = _spans(docs, whole=False)
    base = F.filter("spans", lambda s: s["kind"] < STRONG)

    def count(n):
        return F.size(F.filter("spans", lambda s: s["kind"] == n)).cast("long")

    return d.select(F.col("row.doc_id").cast("long").alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"),
                    count(2).alias("n_hex"), F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


MANY_SPANS = 64
CHUNK_CHARS = 1024


def _cut(text: Column, parts) -> Column:
    """A text's parts between (start, size) places joined with what ``parts`` puts in their place.

    Finding a character's place in a text takes time by its place, so a text with many spans is cut
    in its column ``chunks``, each of CHUNK_CHARS characters, where a place is known at once."""
    def by_chunk(at: Column, n: Column) -> Column:
        def chunk(place):
            return F.floor(place / CHUNK_CHARS).cast("int")

        around = F.transform(F.sequence(chunk(at), chunk(at + F.greatest(n, F.lit(1)) - 1)), lambda k: F.get("chunks", k))
        return F.substring(F.array_join(around, ""), (at % CHUNK_CHARS + 1).cast("int"), n.cast("int"))

    by_text = parts(lambda at, n: F.substring(text, (at + 1).cast("int"), n.cast("int")))
    return F.when(F.col("chunks").isNull(), by_text).otherwise(parts(by_chunk))


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with each span that scan_secrets reports replaced by its kind in angle brackets
    (overlapping ones by the first's); n_chars follows where there is such a column.

    Texts without a span stay as they are, null ones null; a null doc_id stays null; repeated rows
    give repeated results; further columns pass as they are; an empty table gives none."""
    d = _spans(docs, whole=True)
    names = F.array(*map(F.lit, NAMES))
    text = F.col("row.text")
    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK_CHARS}}}"), F.lit(0))
    d = d.withColumn("chunks", F.when(F.size("spans") > MANY_SPANS, chunks))
    last = F.array_max(F.transform("spans", lambda s: s["end"]))

    def joined(piece) -> Column:
        cut = F.transform("spans", lambda s: F.when(s["start"] >= s["before"], F.concat(
            piece(s["before"], s["start"] - s["before"]), F.lit("<"), F.get(names, s["kind"]), F.lit(">"))).otherwise(""))
        return F.concat(F.array_join(cut, ""), piece(last, F.length(text) - last))

    clean = F.when(F.size("spans") == 0, text).otherwise(_cut(text, joined))
    d = d.select("row", clean.alias("clean"))
    same = {"text": F.col("clean"), "n_chars": F.coalesce(F.length("clean"), F.lit(0)).cast(
        docs.schema["n_chars"].dataType if "n_chars" in docs.columns else "long")}
    return d.select(*(same.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
