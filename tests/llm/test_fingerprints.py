"""Signatures against a plain Order MinHash; neighbours against a sorted list."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from carespark.llm import fingerprints as P


def test_kmers_are_numbered():
    rng = random.Random(1)
    for _ in range(300):
        t = "".join(rng.choice("ab") for _ in range(rng.randrange(200)))
        h = P.numbered_kmers(t).tolist()
        seen, names = Counter(), []
        for i in range(len(t) - P.K + 1):
            seen[t[i:i + P.K]] += 1
            names.append((t[i:i + P.K], seen[t[i:i + P.K]]))
        if len(t) >= P.K:
            assert len(h) == len(names) == len(set(h)) and len(set(zip(h, names))) == len(names)


def test_same_kmer_same_hash_anywhere():
    a, b = P.numbered_kmers("xxabcdefghijyy"), P.numbered_kmers("abcdefghijk")
    assert a[2:5].tolist() == b[:3].tolist()
    assert (P.numbered_kmers("ab" * 300_000)[:40] == P.numbered_kmers("ab" * 100)[:40]).sum() >= 40


def test_signature_selects_least_in_text_order():
    rng = random.Random(2)
    for _ in range(50):
        t = "".join(rng.choice("abcd e") for _ in range(rng.randrange(20, 3000)))
        h = P.numbered_kmers(t)
        x = (h ^ h >> np.uint64(32)).astype(np.uint32)
        got = P.signature(t)
        for c in range(0, P.COMPONENTS, 7):
            v = x * P.MULTIPLY[c] + P.ADD[c]
            v ^= v >> np.uint32(15)
            v = v * np.uint32(0x2C1B3C6D)
            v ^= v >> np.uint32(13)
            order = np.lexsort((np.arange(len(v)), v))[:P.LEAST]
            out = np.uint64(0)
            with np.errstate(over="ignore"):
                for i in sorted(order.tolist()):
                    out = (out ^ h[i]) * np.uint64(0x9FB21C651E98DF25)
                    out ^= out >> np.uint64(28)
            assert got[c] == np.uint16(int(out >> np.uint64(40)) & 0xFFFF)


def test_likeness_follows_edits_and_order():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(400)]
    t = " ".join(words)
    s = P.signature(t)
    few = list(words)
    few[200] = "changed"
    blocks = " ".join(words[200:] + words[:200])
    other = " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(400))
    near = [P.likeness(s, P.signature(x)) for x in (t, " ".join(few), P.edited(t, other), other)]
    assert near[0] == 1 and near[1] > 0.8 and 0.15 < near[2] < 0.6 and near[3] < 0.1
    assert P.likeness(s, P.signature(blocks)) < 0.75     # the same k-mers, other order


def brute(rows):
    rows = sorted(((i is not None, i, t or "") for i, t in rows), key=lambda r: (r[0], r[1] or 0, r[2]))
    out = []
    for n, (_, i, t) in enumerate(rows):
        nxt = rows[(n + 1) % len(rows)][2]
        e = P.edited(t, nxt)
        s, se, sn = P.signature(t), P.signature(e), P.signature(nxt)
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), s.tobytes().hex(), se.tobytes().hex(),
                    P.likeness(s, se), P.likeness(s, sn)))
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", [1, 3, 9])
def test_documents(spark, parts):
    rng = random.Random(parts)
    rows = [(i, "".join(rng.choice("ab cdé\U0001f600") for _ in range(rng.choice([0, 1, 3, 7, 8, 40, 500])))) for i in rng.sample(range(-90, 400), 60)]
    rows += [(None, "no id"), (1000, None), (1001, "x" * 200_000), rows[3], rows[3], (rows[4][0], "another text")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, part int").repartition(3)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sorted(map(tuple, P.fingerprint_documents(df).collect()), key=str) == brute(rows)
        assert sorted(map(tuple, P.fingerprint_documents(df.where("doc_id = 1001")).collect()), key=str) == brute([rows[62]])
        assert P.fingerprint_documents(df.limit(0)).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
