"""Each stage against a plain version on its own input; odd rows pass through all stages."""

import re
from array import array
from collections import defaultdict

import corpus_pipeline as P
from tokenizers import Tokenizer

from carespark.llm import toxicity
from carespark.llm.catalog import TOKENIZER
from tests.llm.test_jaccard import brute as near_brute
from tests.llm.test_packing import check_pieces
from tests.llm.test_secrets import brute_spans

SF = "/root/testdata/sf0.001"


def redacted(text):
    out, end = [], 0
    for s, k, e in brute_spans(text):
        if s >= end:
            out += [text[end:s], f"<{['assign', 'access', 'hex', 'ident', 'weak', 'endpoint'][k]}>"]
        end = max(end, e)
    return "".join(out) + text[end:]


def test_stages_against_plain_versions(spark):
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "secrets", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.learn(docs, labels)
    scores = {r.doc_id: r.score for r in toxicity.score_documents(docs, model).collect()}
    rows = {r.doc_id: r.text for r in docs.collect() if scores[r.doc_id] < 0.7}
    steps = [P.write_stage(docs, "t")]
    for name, stage in P.STAGES[:-1]:
        steps.append(P.write_stage(stage(spark, steps[-1], SF), "t"))
        assert sorted(steps[-1].columns) == sorted(docs.columns) and dict(steps[-1].dtypes) == dict(docs.dtypes)
    texts = [{r.doc_id: r.text for r in s.collect()} for s in steps]
    assert texts[1] == rows
    groups = defaultdict(list)
    for i, t in rows.items():
        groups[re.sub("[\x20\x09-\x0d]+", " ", t)].append(i)
    rows = {min(g): rows[min(g)] for g in groups.values()}
    assert texts[2] == rows
    rows = {i: rows[i] for i, _, c in near_brute(sorted(rows.items()), 5, 80) if i == c}
    assert texts[3] == rows
    rows = {i: redacted(t) for i, t in rows.items()}
    assert texts[4] == rows and all(len(r.text) == r.n_chars for r in steps[4].collect())
    tok = Tokenizer.from_file(TOKENIZER)
    ids_of = {i: array("I", tok.encode(t, add_special_tokens=False).ids + [1]).tobytes() for i, t in rows.items()}
    got = P.run(spark, SF).collect()
    check_pieces([(r.doc_id, r.start, bytes(r.ids), r.doc_tokens, r.sequence_id, r.offset) for r in got], ids_of, 2048)
    assert {r.doc_id for r in got} == set(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, None, None, "s", None), (3, "a b c d e f", "en", "s", 11),
            (3, "a b c d e f", "en", "s", 11), (4, "A  b c\nd e f", "en", "s", 12), (5, "word " * 40_000, "x", "s", 200_000),
            (6, "password=abcdefghijkl", "x", "s", 21)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for df, want in ((docs, [None, 1, 3, 5, 6]), (docs.limit(0), [])):
        for _, stage in P.STAGES[:-1]:
            df = P.write_stage(stage(spark, df, SF), "odd")
        got = sorted((r.doc_id for r in df.collect()), key=str)
        assert set(got) <= {None, 1, 3, 5, 6} and got.count(3) <= 1
        if want:
            assert {1, 3, 5, 6} <= set(got)
            assert df.where("doc_id = 6").first().text == "<assign>"
        P.STAGES[-1][1](spark, df, SF).count()


def test_clashing_columns_stay(spark):
    names = ["dropped_id", "row", "uid", "body", "h", "prefix", "id", "kind", "spans", "start", "clean", "edge", "kept", "data", "a.b", "component_id"]
    rows = [(i, t, *[f"{n}{i}" for n in names]) for i, t in enumerate(["x y z", "x  y z", "password=abcdefghijkl", "one two three four five six"])]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names])
    df = docs
    for _, stage in P.STAGES[:-1]:
        df = P.write_stage(stage(spark, df, SF), "clash")
        assert df.columns == docs.columns
    got = {r["doc_id"]: r for r in df.collect()}
    assert set(got) == {0, 2, 3} and got[2]["text"] == "<assign>" and got[3]["a.b"] == "a.b3" and got[0]["kept"] == "kept0"
    assert P.STAGES[-1][1](spark, df, SF).count() >= 3
