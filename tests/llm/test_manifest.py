"""Leaves, roots and proofs against a tree built in memory."""

import hashlib
import random
import zlib

import pytest

from carespark.llm.manifest import manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree(nodes):
    """(root, [(left, right) of each level] by node)."""
    paths = [[] for _ in nodes]
    places = list(range(len(nodes)))
    while len(nodes) > 1:
        for n, p in enumerate(places):
            run = nodes[p // 16 * 16:p // 16 * 16 + 16]
            paths[n].append(("".join(run[:p % 16]), "".join(run[p % 16 + 1:])))
            places[n] = p // 16
        nodes = [h(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute(rows):
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = [sorted(((r[0] is not None, r[0] or 0, leaf(*r)), r) for r in rows if r[3] == s) for s in sources] if rows else []
    trees = [tree([k[2] for k, _ in g]) for g in groups]
    root, tops = tree([t[0] for t in trees]) if trees else (None, [])
    out = []
    for g, (sub, paths), top in zip(groups, trees, tops):
        for (key, r), path in zip(g, paths):
            path = path + top
            folded = key[2]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
                folded = leaf(r[0], low, *r[2:])
            for left, right in path:
                folded = h(left, folded, right)
            out.append((r[0], key[2], sub, root, h(*[a + b for a, b in path]), folded, folded == root))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "doc_id long, text string, lang string, source string, n_chars int, key string, place int")
    return sorted(map(tuple, manifest(df.repartition(3)).collect()), key=str)


def docs(rng, n, source):
    return [(i, rng.choice(["Upper", "lower", None, "ÄÜ x", "", "A:1-"]) if i % 3 else f"Text {i}", "en", source, i) for i in rng.sample(range(10 * n), n)]


def test_cases(spark):
    rows = [(1, "A", "en", None, 1), (2, None, None, "b", None), (3, "", "de", "B", 0), (None, "Null id", "en", "b", 7), (None, "x", "en", "b", 1),
            (4, "X" * 300_000, "en", "é", 300_000), (5, "twice", "en", "b", 5), (5, "twice", "en", "b", 5), (5, "Other", "en", "b", 5),
            (-6, "neg", "en", "", 3), (2 ** 62, "big", "en", "-", 3)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:1]) == brute(rows[:1])
    assert run(spark, []) == []


@pytest.mark.parametrize("sizes", [(1, 16, 17), (15, 256, 257), (2, 4097), (300,)])
def test_sizes_around_full_blocks(spark, sizes):
    rng = random.Random(sum(sizes))
    rows = [r for k, n in enumerate(sizes) for r in docs(rng, n, f"s{k}")]
    assert run(spark, rows) == brute(rows)


def test_many_sources(spark):
    rng = random.Random(3)
    rows = [(i, f"T{i}", "en", f"source {rng.randrange(10 ** 6)}", 3) for i in range(700)]
    assert run(spark, rows) == brute(rows)
