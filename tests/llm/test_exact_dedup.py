"""Groups of equal texts against a dictionary in memory, hot groups over many partitions included."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from carespark.llm.exact_dedup import exact_duplicates


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", t or "")].append(i)
    out = []
    for body, ids in groups.items():
        known = [i for i in ids if i is not None]
        ids = sorted(known) + [None] * (len(ids) - len(known))
        out += [(i, ids[0], len(ids), n == 0, hashlib.sha256(body.encode()).hexdigest()) for n, i in enumerate(ids)]
    return sorted(out, key=str)


def run(spark, rows, parts=4):
    df = spark.createDataFrame([(i, t, 1.5) for i, t in rows], "doc_id long, text string, kept double").repartition(parts)
    return df, sorted(map(tuple, exact_duplicates(df).collect()), key=str)


CASES = [(1, None), (2, ""), (3, "a b"), (4, "a \t b"), (5, "a\nb "), (6, "a b "), (None, "a b"), (None, "only"), (7, "x" * 200_000),
         (8, "x" * 200_000), (8, "x" * 200_000), (9, " "), (10, "\r\n"), (11, "a b")]


def test_cases(spark):
    df, got = run(spark, CASES)
    assert got == brute(CASES)
    kept = exact_duplicates(df, keep_rows=True)
    assert kept.schema == df.schema
    want = sorted(((i, k) for i, _, _, k, _ in brute(CASES) if k), key=str)
    assert sorted(((r.doc_id, True) for r in kept.collect()), key=str) == want
    assert exact_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_hot_groups_over_many_partitions(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["hot text", "hot\ttext", f"text {rng.randrange(40)}", f"own {i}"])) for i in rng.sample(range(3000), 1500)]
    rows += rows[:50]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        df, got = run(spark, rows)
        assert got == brute(rows)
        assert sorted(r.doc_id for r in exact_duplicates(df, keep_rows=True).collect()) == sorted(r[0] for r in brute(rows) if r[3])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
