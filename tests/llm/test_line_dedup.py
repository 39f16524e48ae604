"""Shared lines against dictionaries in memory."""

import random
import re
from collections import defaultdict

import pytest

from carespark.llm.line_dedup import drop_shared_lines


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip("\x20\x09\x0a\x0b\x0c\x0d"))


def brute(rows, chars=40, documents=5):
    low = -(1 << 70)
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= chars:
                holders[key(line)].add(low if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= chars and len(holders[key(x)]) >= documents
                                         and max(holders[key(x)]) != (low if i is None else i))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, h int, key string").repartition(3)
    return sorted(map(tuple, drop_shared_lines(df, **kw).collect()), key=str)


LONG = "This Line Is Long Enough To Be Counted As A Shared One"
CASES = [(i, f"own {i}\n{LONG}\n\t {LONG.lower()} \x0b\nshort") for i in range(6)] + [
    (10, None), (11, ""), (12, "\n\n"), (None, LONG), (None, "x\n" + LONG), (3, LONG + "\nother version"), (5, LONG),
    (20, "É" * 40), (21, "é" * 40), (22, "É" * 40), (23, "É" * 40), (24, "É" * 40), (25, "É" * 40 + "\r"),
    (30, "y" * 300_000), (31, " " * 50 + "a" * 39 + " " * 50), (32, LONG + "\n" + LONG)]


def test_cases(spark):
    assert run(spark, CASES) == brute(CASES)
    assert run(spark, CASES[-6:]) == brute(CASES[-6:])
    df = spark.createDataFrame(CASES[:2], "doc_id long, text string").limit(0)
    assert drop_shared_lines(df).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_random(spark, seed):
    rng = random.Random(seed)
    pool = [f"{'Line' if i % 2 else 'Zeile'} {i} " + "ab " * 14 for i in range(12)] + ["short", "", " "]
    rows = [(rng.randrange(80), "\n".join(rng.choice(pool) + rng.choice(["", " ", "\r"]) for _ in range(rng.randrange(12)))) for _ in range(120)]
    assert run(spark, rows, least_chars=20, least_documents=15) == brute(rows, 20, 15)
