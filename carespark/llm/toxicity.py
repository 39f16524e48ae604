"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's probability is a logistic function of the hashed features of its
words (the word, and its character n-grams with word ends). A document is toxic
if any of its sentences is: the noisy-or P = 1 - prod(1 - p). With
A = sum(softplus(z)) over its sentences, P = 1 - exp(-A), so the gradient of the
label's log-likelihood reaches each sentence as its responsibility, and the
sentences that make a document toxic are found without labels of their own.

Words are runs without white space. A run that has a full-width mark inside, or
more than RUN_CHARS characters, is cut after its marks and then every RUN_CHARS
characters, so that a sentence in a text without spaces is an instance too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carespark.llm.common import ROWS_AT_ONCE, map_arrow, texts_of
from carespark.llm.labelled import held_out, labelled_sample
from carespark.llm.subwords import WordValues, summed_weights
from carespark.llm.subwords import word_features as features_of

PER_CLASS = 1500        # labelled documents of each label to learn from, at most
MAX_CHARS = 50_000      # longer ones are not learned from (all are scored)
BUCKETS = 1 << 18
GRAMS = (4, 5)
SENTENCE_WORDS = 48     # a sentence without a full stop ends after so many words
OFFENDING = 0.5         # sentences of this probability are reported
TOXIC = 0.7
ASSOCIATION = 12.0      # likelihood ratio of a feature's going with toxic documents of the sample
DECAY = 3e-6            # weight of the squared weights in the loss
ENDS = (".", "!", "?", "。", "！", "？")
EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„’"
RUN_CHARS = 40          # longer runs without white space are cut
WIDE_ENDS = "".join(ENDS[3:])
CUT_RUN = re.compile(f"\\S{{{RUN_CHARS + 1}}}|[{WIDE_ENDS}][^\\s{WIDE_ENDS}]")   # a text without these needs no cutting
ANY_PIECE = re.compile(f"[^{re.escape(''.join(ENDS))}]*[{re.escape(''.join(ENDS))}]*")
WIDE_PIECE = re.compile(f"[^{WIDE_ENDS}]*[{WIDE_ENDS}]*")


def run_pieces(run: str) -> Iterator[str]:
    """A run's pieces, in order and without gaps."""
    for m in (ANY_PIECE if len(run) > RUN_CHARS else WIDE_PIECE).finditer(run):
        piece = m[0]
        for at in range(0, len(piece), RUN_CHARS):
            yield piece[at:at + RUN_CHARS]


def words_of(text: str) -> list[str]:
    """A text's words, in order."""
    runs = text.split()
    return [p for r in runs for p in run_pieces(r)] if CUT_RUN.search(text) else runs


def places_of(text: str) -> list[tuple[int, int]]:
    """Start and end of each word."""
    out = []
    for m in re.finditer(r"\S+", text):
        at = m.start()
        for piece in run_pieces(m[0]):
            out.append((at, at + len(piece)))
            at += len(piece)
    return out


def core_of(word: str) -> str:
    """What a word's features are taken of; empty for one that is all punctuation."""
    return word.strip(EDGE).lower()


def word_features(words: list[str]) -> list[np.ndarray]:
    """Buckets of each word's features."""
    cores = [core_of(w) for w in words]
    none = np.empty(0, np.int32)
    return [f if c else none for f, c in zip(features_of(cores, GRAMS, BUCKETS), cores)]


def sentence_starts(words: list[str]) -> np.ndarray:
    """Index of the first word of each sentence; a text without words is one empty sentence."""
    ends = np.fromiter((w.endswith(ENDS) for w in words), bool, len(words))
    return cuts(ends)


def cuts(ends: np.ndarray) -> np.ndarray:
    n = len(ends)
    first = np.concatenate(([0], np.flatnonzero(ends) + 1))
    first = first[(first < n) | (first == 0)]
    size = np.diff(np.append(first, n))
    if not len(size) or size.max() <= SENTENCE_WORDS:
        return first
    more = np.maximum(-(-size // SENTENCE_WORDS), 1)
    base = np.repeat(first, more)
    nth = np.arange(len(base)) - np.repeat(np.cumsum(more) - more, more)
    return base + nth * SENTENCE_WORDS


class Model:
    """Feature weights and bias; ``logits`` gives the sentences' logits of texts."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self.values = WordValues(self._values)

    def _values(self, words: list[str]) -> list[float]:
        cores = [core_of(w) for w in words]
        total, count = summed_weights(cores, self.weights, GRAMS, BUCKETS)
        value = np.where(np.fromiter(map(bool, cores), bool, len(cores)), total / np.sqrt(count), 0.0)
        ends = np.fromiter((w.endswith(ENDS) for w in words), bool, len(words))
        return (value + 1e6 * ends).tolist()       # 1e6 marks a sentence's end

    def logits(self, rows: list[list[str]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text's words, the first words of its sentences and the sentences' logits."""
        value = self.values.of(rows)
        for words in rows:
            if not words:
                yield np.zeros(1, np.int64), np.full(1, self.bias)
                continue
            v = np.fromiter(map(value.__getitem__, words), float, len(words))
            ends = v > 5e5
            v[ends] -= 1e6
            first = cuts(ends)
            yield first, np.add.reduceat(v, first) + self.bias


def noisy_or(z: np.ndarray) -> float:
    """Probability that any sentence is toxic, from the sentences' logits."""
    return min(max(-float(np.expm1(-np.logaddexp(0, z).sum())), 0.0), 1.0)


def association(ones: np.ndarray, zeros: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """For each bucket, the likelihood ratio statistic of its occurring in documents with label 1
    rather than 0: it occurs in ``ones`` of n1 and ``zeros`` of n0; 0 where it goes with label 0."""
    out = np.zeros(len(ones))
    rate = (ones + zeros) / (n1 + n0)
    for seen, all_ in ((ones, n1), (zeros, n0)):
        for part, share in ((seen, rate), (all_ - seen, 1 - rate)):
            expect = all_ * share
            out += 2 * np.where(part > 0, part * np.log(np.maximum(part, 1e-9) / np.maximum(expect, 1e-9)), 0)
    return np.where(ones * n0 > zeros * n1, out, 0)


def fit(texts: list[str], y: np.ndarray, weights: np.ndarray, epochs: int = 120, rate: float = 0.2, decay: float = DECAY) -> Model:
    """Maximum likelihood of the noisy-or by full-batch Adam. Without rows of both labels the
    model is constant: the share of toxic rows, 0 if there are none."""
    if not len(texts) or y.min() == y.max():
        share = min(max(float(y.mean()) if len(y) else 0.0, 1e-6), 1 - 1e-6)
        return Model(np.zeros(BUCKETS), float(np.log(np.expm1(-np.log1p(-share)))))
    # only features that go with the label beyond chance; the others could only be learned by heart
    seen: dict[str, np.ndarray] = {}
    counts = np.zeros((2, BUCKETS))
    for d, text in enumerate(texts):
        words = set(words_of(text))
        new = sorted(words.difference(seen))
        seen.update(zip(new, word_features(new)))
        if words:
            counts[int(y[d] == 0), np.unique(np.concatenate([seen[w] for w in words]))] += 1
    known = association(counts[0], counts[1], float((y == 1).sum()), float((y == 0).sum())) >= ASSOCIATION
    kept = {w: (f[known[f]], len(f) ** -0.5) for w, f in seen.items() if known[f].any()}
    del seen
    feats, value, sentence, docs, n = [], [], [], [], 0
    for d, text in enumerate(texts):
        words = words_of(text)
        first = sentence_starts(words)
        docs.append(np.full(len(first), d))
        for i, w in enumerate(words):
            if w in kept:
                f, scale = kept[w]
                feats.append(f)
                value.append(np.full(len(f), scale))
                sentence.append(np.full(len(f), n + np.searchsorted(first, i, side="right") - 1))
        n += len(first)
    docs = np.concatenate(docs)
    feats, value, sentence = ((np.concatenate(x) if x else np.empty(0, kind)) for x, kind in ((feats, np.int64), (value, float), (sentence, np.int64)))
    used, feats = np.unique(feats, return_inverse=True)
    w, bias = np.zeros(len(used)), -5.0
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for step in range(1, epochs + 1):
        z = np.bincount(sentence, w[feats] * value, n) + bias
        p = 1 / (1 + np.exp(-z))
        a = np.bincount(docs, np.logaddexp(0, z), len(texts))
        g = weights * np.where(y == 1, -1 / np.maximum(np.expm1(np.minimum(a, 50)), 1e-12), 1.0)
        gs = g[docs] * p
        gw = np.bincount(feats, gs[sentence] * value, len(used)) + decay * w
        gb = gs.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        c1, c2 = 1 - 0.9 ** step, 1 - 0.99 ** step
        w -= rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        bias -= rate * (mb / c1) / (vb / c2 + 1e-16) ** 0.5
    out = np.zeros(BUCKETS)
    out[used] = w
    return Model(out, float(bias))


SCHEMA = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("offending", pa.list_(
    pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))])


def _score_task(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                ids, column = batch.slice(at, ROWS_AT_ONCE).columns
                texts = column.to_pylist()
                rows, scores, found = [words_of(t) for t in texts], [], []
                for text, words, (first, z) in zip(texts, rows, model.logits(rows)):
                    scores.append(noisy_or(z))
                    bad = np.flatnonzero(z >= np.log(OFFENDING / (1 - OFFENDING))) if words else []
                    spans = []
                    if len(bad) and len(places := places_of(text)) == len(words):
                        last = np.append(first[1:], len(words)) - 1
                        spans = [{"start": places[first[s]][0], "end": places[last[s]][1], "score": float(1 / (1 + np.exp(-z[s])))} for s in bad]
                    found.append(spans)
                yield pa.record_batch([ids, pa.array(scores, pa.float64()), pa.array(found, SCHEMA.field("offending").type)], schema=SCHEMA)

    return run


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Model:
    """Fit on a bounded sample of the labelled documents that are not held out."""
    return fit(*labelled_sample(docs, labels, "toxic", per_class, max_chars))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, offending) for each row: the whole text's probability to be toxic and its
    offending sentences (start, end in characters, score). A null or empty text is one empty
    sentence; a null doc_id stays null; repeated rows give repeated results; further columns
    are not read; an empty table gives none."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    return map_arrow(
        texts_of(docs), _score_task(shared), "doc_id long, score double, offending array<struct<start: long, end: long, score: double>>")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = TOXIC) -> DataFrame:
    """The rows whose score is below ``threshold``, with all their columns; texts pass through Python
    once. A null or empty text is one empty sentence; null ids, repeated rows and further columns
    pass as they are; an empty table gives none."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                rows = [words_of(text or "") for text in part.column(0).field("text").to_pylist()]
                keep = [noisy_or(z) < threshold for _, z in m.logits(rows)]
                yield part.filter(pa.array(keep, pa.bool_()))

    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    d = docs.select(whole)
    out = T.StructType([T.StructField("row", d.schema["row"].dataType)])
    return map_arrow(d, run, out).select("row.*")


def toxicity(docs: DataFrame, labels: DataFrame, **sample) -> DataFrame:
    """Scores of all documents by a model that learns from ``labels``:
    (doc_id, held_out, score, predicted, offending)."""
    scored = score_documents(docs, learn(docs, labels, **sample))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= TOXIC).cast("int").alias("predicted"), "offending")
