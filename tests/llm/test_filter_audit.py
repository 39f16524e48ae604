"""The audit against plain filtering in every order."""

import random
import re
from itertools import permutations

import pytest

from carespark.llm.filter_audit import COLUMNS, audit_filters, gray_walk


def failures(rows):
    ids = {}
    for i, t, _ in rows:
        if i is not None:
            ids[t or ""] = min(i, ids.get(t or "", i))
    out = []
    for i, t, part in rows:
        t = t or ""
        words = re.findall("[^\x20\x09-\x0d]+", t)
        least = ids.get(t)
        out.append({"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                    "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search("[#$%&*|]", t)),
                    "E": least is not None and (i is None or least < i)})
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}   # a null id is no id
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    fails = failures(rows)
    out = []
    for part in {p or "" for _, _, p in rows}:
        mine = [(r[0], f) for r, f in zip(rows, fails) if (r[2] or "") == part]
        here, total = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if f[letter]]
                left = [(i, f) for i, f in left if not f[letter]]
                total[letter] += len(gone)
                here.append((part, "".join(order), step, len(left), len(gone), sum(f[letter] for _, f in mine) - len(gone),
                             sum(f[letter] and sum(f.values()) == 1 for _, f in mine), sum(i in good for i, _ in gone),
                             sum(i in toxic for i, _ in gone), letter))
        out += [(*row[:-1], total[row[-1]]) for row in here]
    return sorted(out)


def run(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, p, 1, 2) for i, t, p in rows], "doc_id long, text string, lang string, mask int, good int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit_filters(docs.repartition(3), marks)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()))


LONG = " ".join(f"w{i}" for i in range(300))
CASES = [(1, None, "en"), (2, "", None), (3, "", ""), (4, LONG, "en"), (5, LONG, "de"), (5, LONG, "de"), (5, LONG, "en"), (None, LONG, "en"),
         (None, "own", "en"), (None, "own", "en"), (6, "A B\x0bC #  x", "fr"), (7, "word " * 200_000, "fr"), (8, "same " * 150, "en"),
         (9, " \t\r\n", "en"), (10, "x x", "en"), (10, "y", "en"), (11, "ÄÖ $", "de")]
MARKS = [(1, 1, 0), (4, 1, 1), (5, 0, 1), (5, 1, 0), (6, None, None), (None, 1, 1), (99, 1, 1), (7, 0, 1)]


def test_cases(spark):
    assert run(spark, CASES, MARKS) == brute(CASES, MARKS)


def test_empty_tables(spark):
    assert run(spark, [], MARKS) == []
    assert run(spark, CASES[:4], []) == brute(CASES[:4], [])


@pytest.mark.parametrize("seed", range(3))
def test_random_rows_with_a_hot_text(spark, seed):
    rng = random.Random(seed)
    texts = ["hot text", LONG, LONG + " #", "Shout " * 250, "a b " * 150, ""]
    rows = [(i, rng.choice(texts) if rng.random() < 0.8 else f"own {i} {LONG if i % 2 else ''}", rng.choice(["en", "de", None]))
            for i in rng.sample(range(5000), 400)]
    labels = [(i, rng.randrange(2), rng.randrange(2)) for i, _, _ in rows if rng.random() < 0.5]
    assert run(spark, rows, labels) == brute(rows, labels)


def test_walk_states_are_the_survivors_of_each_subset():
    rng = random.Random(5)
    cells = [(m, rng.randrange(9), rng.randrange(5), rng.randrange(3)) for m in range(16)]
    for subset, state in enumerate(gray_walk(cells, 4)):
        assert state == tuple(sum(c[j] for c in cells if not c[0] & subset) for j in (1, 2, 3))
