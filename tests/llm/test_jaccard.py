"""Links and components against all pairs in memory."""

import random
import re

import numpy as np
import pytest

from carespark.llm import jaccard
from carespark.llm.components import connected_components


def shingles(text, k):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, r in sets[:a]:
            if i is not None and j is not None and s and r and 100 * len(s & r) >= percent * len(s | r):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=str)


def family(rng, base, copies, edits):
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            at = rng.randrange(len(w) + 1)
            w[at:at + rng.randrange(2)] = [f"e{rng.randrange(10 ** 6)}"] * rng.randrange(2)
        out.append(" ".join(w))
    return out


def corpus(seed):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(25)]
    texts = []
    for f in range(6):
        base = [f"w{rng.randrange(60 if f % 2 else 5000)}" for _ in range(rng.choice([4, 12, 40, 90]))]
        if f % 3 == 0:
            base += passage
        texts += family(rng, base, rng.choice([2, 5, 25]), 8)
    texts += [" ".join([f"u{rng.randrange(10 ** 6)}" for _ in range(30)] + passage) for _ in range(15)]
    texts += ["", None, "one", "ONE", "one two", "one\ttwo", "É a b", "é a b", "a b c a b c a b c", " \n", "x " * 5000]
    rng.shuffle(texts)
    texts += texts[:10]
    ids = rng.sample(range(-50, 1000), len(texts))
    rows = list(zip(ids, texts))
    return rows + [(None, texts[3]), (ids[0], texts[5]), (ids[1], texts[1])]


@pytest.mark.parametrize("percent,k", [(90, 3), (80, 5), (50, 1)])
def test_cluster_against_pairs(percent, k):
    rng = random.Random(percent)
    for _ in range(60):
        base = [f"w{rng.randrange(200)}" for _ in range(rng.choice([3, 20, 60]))]
        sets = [shingles(t, k) for t in family(rng, base, rng.randrange(2, 30), 10)]
        sets = [s for s in sets if s]
        if len(sets) < 2:
            continue
        code = {}
        coded = [np.sort(np.array([code.setdefault(x, len(code)) for x in s], np.uint64)) for s in sets]
        comp = jaccard.link_cluster(coded, rng.randrange(len(sets)), percent)
        want = brute([(i, None) for i in range(len(sets))], k, percent)
        root = list(range(len(sets)))
        for a in range(len(sets)):
            for b in range(a):
                if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and root[a] != root[b]:
                    old, new = root[a], root[b]
                    root = [new if r == old else r for r in root]
        assert len(want) == len(sets)
        assert {(a, b) for a in range(len(sets)) for b in range(a) if root[a] == root[b]} == \
            {(a, b) for a in range(len(sets)) for b in range(a) if comp[a] == comp[b]}


@pytest.mark.parametrize("seed,percent,k,chunk", [(0, 90, 3, 1 << 21), (1, 80, 5, 300), (2, 90, 3, 500)])
def test_components_against_pairs(spark, monkeypatch, seed, percent, k, chunk):
    monkeypatch.setattr(jaccard, "CHUNK_SHINGLES", chunk)
    monkeypatch.setattr(jaccard, "CHUNK_OUTLINES", 2 * chunk)
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, token string, n int").repartition(3)
    assert sorted(map(tuple, jaccard.jaccard_components(docs, k, percent).collect()), key=str) == brute(rows, k, percent)


def test_outlines_refuse_no_link():
    rng = np.random.default_rng(5)
    for percent in (50, 80, 90):
        for _ in range(60):
            sets = []
            for _ in range(rng.integers(2, 12)):
                base = rng.integers(0, 1 << 64, rng.choice([1, 5, 60, 500, 3000]), dtype=np.uint64)
                for _ in range(rng.integers(1, 4)):
                    keep = rng.random(len(base)) < rng.choice([0.3, 0.85, 0.95, 1.0])
                    extra = rng.integers(0, 1 << 64, rng.integers(0, len(base) // 10 + 1), dtype=np.uint64)
                    s = np.unique(np.concatenate((base[keep], extra)))
                    if len(s):
                        sets.append(s)
            may = jaccard.may_link([jaccard.outline(s) for s in sets], np.array([len(s) for s in sets]), percent)
            for a in range(len(sets)):
                for b in range(a):
                    both = len(np.intersect1d(sets[a], sets[b]))
                    if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                        assert may[a] and may[b]
    lone = [np.unique(rng.integers(0, 1 << 64, 500, dtype=np.uint64)) for _ in range(20)]
    assert not jaccard.may_link([jaccard.outline(s) for s in lone], np.array([len(s) for s in lone]), 80).any()


def test_prefix_is_the_head_of_one_order():
    rng = np.random.default_rng(3)
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, rng.integers(1, 60), dtype=np.uint64)
        s = rng.choice(pool, rng.integers(1, 120))
        scores = dict(zip(pool.tolist(), rng.integers(0, 5, len(pool)).tolist()))
        frequent = np.sort(rng.choice(pool, rng.integers(0, len(pool) + 1), replace=False))
        rank = rng.integers(1 << 10, 1 << 11, len(frequent)).astype(np.uint64)
        ranks = dict(zip(frequent.tolist(), rank.tolist()))
        order = sorted(set(s.tolist()), key=lambda x: (ranks.get(x, scores[x]), x))
        for size in {1, len(order) // 10 + 1, len(order)}:
            got = jaccard.prefix(s, np.array([scores[x] for x in s.tolist()], np.uint64), size, frequent, rank)
            assert got.tolist() == order[:size]


def test_one_of_each_group_and_empty(spark):
    rows = corpus(4)
    docs = spark.createDataFrame([(i, t, 2.0) for i, t in rows], "doc_id long, text string, a double")
    kept = jaccard.one_of_each_group(docs, 5, 80)
    want = [i for (i, _, c) in brute(rows, 5, 80) if i == c]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str) and kept.columns == docs.columns
    assert jaccard.jaccard_components(docs.limit(0)).count() == 0


def test_connected_components(spark):
    rng = random.Random(9)
    n = 300
    pairs = [(i, i + 1) for i in range(60)] + [(100, j) for j in range(101, 160)] + \
        [(rng.randrange(160, n), rng.randrange(160, n)) for _ in range(110)] + [(5, 5), (None, 3), (7, None)]
    root = {x: x for p in pairs for x in p if x is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    touched = {x for a, b in pairs if a is not None and b is not None and a != b for x in (a, b)}
    got = connected_components(spark.createDataFrame(pairs, "a long, b long"))
    assert sorted(map(tuple, got.collect())) == sorted((x, find(x)) for x in touched)
