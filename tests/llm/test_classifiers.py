"""Noisy-or and subword embeddings: gradients, held-out accuracy, odd inputs."""

import random
import zlib

import numpy as np
import pytest

from carespark.llm import quality, subwords, toxicity
from carespark.llm.labelled import labelled_sample

SF = "/root/testdata/sf0.1"


def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def judged(result, labels, column):
    rows = result.where("held_out").join(labels.select("doc_id", column), "doc_id").collect()
    y = np.array([r[column] for r in rows])
    p = np.array([r["predicted"] for r in rows])
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) == r.held_out for r in rows)
    return y, p, np.array([r["score"] for r in rows])


def auc(y, s):
    rank = np.argsort(np.argsort(s))
    return (rank[y == 1].mean() - rank[y == 0].mean()) / len(s) + 0.5


def test_toxicity_held_out(spark):
    docs, labels = tables(spark)
    y, p, s = judged(toxicity.toxicity(docs, labels), labels, "toxic")
    assert (y == p).mean() > 0.96 and auc(y, s) > 0.95 and s.min() >= 0 and s.max() <= 1


def test_quality_held_out(spark):
    docs, labels = tables(spark)
    y, p, s = judged(quality.quality(docs, labels), labels, "quality")
    assert (y == p).mean() > 0.97 and auc(y, s) > 0.98


def test_offending_sentences_are_found_without_sentence_labels():
    rng = random.Random(2)
    words = [f"word{i}" for i in range(300)]

    def sentence(bad):
        out = [rng.choice(words) for _ in range(8)]
        if bad:
            out[rng.randrange(8)] = rng.choice(["vileness", "grimword"])
        return " ".join(out) + "."

    texts, y, where = [], [], []
    for _ in range(400):
        bad = rng.random() < 0.4
        at = rng.randrange(6) if bad else None
        texts.append(" ".join(sentence(i == at) for i in range(6)))
        y.append(float(bad))
        where.append(at)
    m = toxicity.fit(texts, np.array(y), np.full(400, 1 / 400))
    hits = 0
    for t, at in zip(texts, where):
        (_, z), = m.logits([t.split()])
        assert len(z) == 6
        hits += (at is None and z.max() < 0) or (at is not None and z.argmax() == at and z.max() > 0)
    assert hits >= 396


def test_sentence_cuts():
    n = toxicity.SENTENCE_WORDS
    assert toxicity.sentence_starts([]).tolist() == [0]
    assert toxicity.sentence_starts(["a.", "b", "c!", "d"]).tolist() == [0, 1, 3]
    assert toxicity.sentence_starts(["a"] * (2 * n + 1)).tolist() == [0, n, 2 * n]


@pytest.mark.parametrize("module,column", [(toxicity, "toxic"), (quality, "quality")])
def test_odd_rows(spark, module, column):
    rows = [(1, None, "en", 1), (2, "", "en", 1), (None, "stupid text.", "fr", 1), (3, "x " * 100_000, "en", 1), (4, "same.", "", 0),
            (4, "same.", "", 0)]
    docs = spark.createDataFrame([(i, t, la, 0.5) for i, t, la, _ in rows], "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(i, y, y) for i, _, _, y in rows] + [(9, None, None)], "doc_id long, quality int, toxic int")
    run = getattr(module, column if column == "quality" else "toxicity")
    got = run(docs, labels).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted((r[0] for r in rows), key=str)
    assert all(0 <= r.score <= 1 for r in got)
    same = [r.score for r in got if r.doc_id == 4]
    assert same[0] == same[1]
    for empty in (run(docs, labels.limit(0)), run(docs, labels.where(f"{column} = 1"))):
        assert empty.count() == len(rows)      # a constant model
    assert run(docs.limit(0), labels).count() == 0


def test_sample_is_bounded_and_never_held_out(spark):
    docs, labels = tables(spark)
    texts, y, w = labelled_sample(docs, labels, "toxic", 40, 2000)
    assert len(texts) == 80 and (y == 1).sum() == 40 and max(map(len, texts)) <= 2000 and abs(w.sum() - 1) < 1e-9
    held = {r.text for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1} - \
        {r.text for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 != 1}
    assert not held & set(texts)


def test_drop_toxic(spark):
    docs, labels = tables(spark)
    docs = docs.limit(500).cache()
    m = toxicity.learn(*tables(spark))
    kept = toxicity.drop_toxic(docs, m)
    scores = {r.doc_id: r.score for r in toxicity.score_documents(docs, m).collect()}
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, s in scores.items() if s < toxicity.TOXIC)


def test_quality_reads_the_middle_of_an_unspaced_text():
    rng = random.Random(4)

    def run(letters, n):
        return "".join(rng.choice(letters) for _ in range(n))

    def unspaced(good, n):
        return "h" * 200 + run("abc好的" if good else "xyz坏的", n) + "t" * 200

    y = np.array([1.0, 0.0] * 60)
    m = quality.fit([unspaced(v, rng.randrange(100, 3000)) for v in y], y, np.full(120, 1 / 120))
    good, bad = unspaced(True, 9600), unspaced(False, 9600)
    assert len(good) == len(bad) == 10_000 and m.score(good) > 0.9 and m.score(bad) < 0.1
    assert not any(len(w) > subwords.WORD_CHARS for w in m.words.kept)


def plain_buckets(word, grams, buckets):
    """Features of one word, gram by gram, with integers."""
    out, marked, all_ones = [zlib.crc32(word.encode()) % buckets], f"<{word}>", 2 ** 64 - 1
    for n in grams:
        for i in range(len(marked) - n + 1):
            codes = [ord(c) + 1 for c in marked[i:i + n]]
            h = codes[0] + n
            for c in codes[1:]:
                h = (h * int(subwords.STEP) + c) & all_ones
            h = ((h ^ h >> 32) * int(subwords.MIX)) & all_ones
            out.append(h >> (64 - (buckets.bit_length() - 1)))
    return out


WORDS = ["a", "", "word", "stupid", "naïve", "日本語", "\U0001f600x", "q" * 41, "ab" * 70_000, "w" * 65_533, "xyz", "z" * 65_600]


@pytest.mark.parametrize("grams,buckets", [((2, 3), 1 << 17), ((4, 5), 1 << 18)])
def test_features_come_once_whatever_the_windows(grams, buckets):
    for words in (WORDS, WORDS[::-1], [w + str(i) for i in range(3000) for w in WORDS[:8]]):
        got = subwords.word_features(words, grams, buckets)
        want = [plain_buckets(w, grams, buckets) for w in words]
        assert [sorted(g.tolist()) for g in got] == [sorted(w) for w in want]
        weights = np.random.default_rng(1).normal(size=buckets)
        total, count = subwords.summed_weights(words, weights, grams, buckets)
        assert count.tolist() == [len(w) for w in want]
        assert np.allclose(total, [weights[w].sum() for w in want], atol=1e-8)
        for w, t in zip(words, total):       # the same value in any company
            assert subwords.summed_weights([w], weights, grams, buckets)[0][0] == t


def test_kept_words_are_bounded(monkeypatch):
    monkeypatch.setattr(subwords, "WORDS_KEPT", 50)
    values = subwords.WordValues(lambda ws: [len(w) for w in ws])
    rng = random.Random(1)
    for _ in range(200):
        rows = [[f"{rng.randrange(300)}" * rng.randrange(1, 30) for _ in range(rng.randrange(12))] for _ in range(3)]
        got = values.of(rows)
        assert all(got[w] == len(w) for r in rows for w in r)
        assert len(values.kept) <= 50 + 36 and all(len(w) <= subwords.WORD_CHARS for w in values.kept)


def odd_texts():
    rng = random.Random(9)
    bits = ["stupid", "good.", "3.14", "idiot!", "www.x.org/" + "a" * 50, "你好。我", "恨。", "!!", "x" * 100, "\n", "  ", "«word»", "T" * 41 + "."]
    return ["", " ", "\x1c"] + ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randrange(40))) for _ in range(150)]


def test_quality_scores_against_a_plain_scorer():
    weights = np.random.default_rng(3).normal(size=quality.BUCKETS + 1)
    m, texts = quality.Model(weights, -0.3), odd_texts()
    for text, got in zip(texts, m.scores(texts)):
        words = text.split()
        features = [f for w in words for f in plain_buckets(w, quality.GRAMS, quality.BUCKETS)]
        features += [quality.BUCKETS for a, b in zip(words, words[1:]) if a == b]
        z = (sum(weights[f] for f in features) / len(features) if features else 0) - 0.3
        assert abs(got - 1 / (1 + np.exp(-z))) < 1e-9


def test_toxicity_scores_against_a_plain_scorer():
    weights = np.random.default_rng(4).normal(size=toxicity.BUCKETS)
    m = toxicity.Model(weights, -1.5)
    for text in odd_texts():
        words = toxicity.words_of(text)
        assert [text[a:b] for a, b in toxicity.places_of(text)] == words and "".join(words) == "".join(text.split())
        sentences, here = [], []
        for w in words:
            here.append(w)
            if w[-1] in ".!?。！？" or len(here) == toxicity.SENTENCE_WORDS:
                sentences.append(here)
                here = []
        sentences += [here] if here or not sentences else []
        clean = 1.0
        for s in sentences:
            z = -1.5
            for w in s:
                core = w.strip(toxicity.EDGE).lower()
                if core:
                    f = plain_buckets(core, toxicity.GRAMS, toxicity.BUCKETS)
                    z += sum(weights[i] for i in f) / len(f) ** 0.5
            clean *= 1 - 1 / (1 + np.exp(-z))
        (_, z), = m.logits([words])
        assert abs(toxicity.noisy_or(z) - (1 - clean)) < 1e-9, text


@pytest.mark.parametrize("mark", ["。", ".", "！"])
def test_a_toxic_sentence_counts_alike_in_short_and_long_unspaced_texts(mark):
    weights = np.zeros(toxicity.BUCKETS)
    weights[plain_buckets("坏人真坏恶心", toxicity.GRAMS, toxicity.BUCKETS)] = 2.0
    m = toxicity.Model(weights, -4.0)
    most = []
    for n in (10, 20, 12_500):
        text = ("好人好事" * 2 + mark) * n + "坏人真坏恶心" + mark + ("天气很好啊" + mark) * n
        (first, z), = m.logits([toxicity.words_of(text)])
        most.append(round(float(z.max()), 9))
        assert len(first) == 2 * n + 1
    assert most[0] == most[1] == most[2] > 0
