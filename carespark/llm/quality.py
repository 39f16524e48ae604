"""Text quality by supervised subword embeddings.

Each word and each of its character n-grams, whatever its length, has a learned
vector in a hashed table; a document is the average of its features' vectors, and a softmax over
two classes reads it. Words count as written (case and punctuation marks are
signs of quality), and a word that repeats the one before adds a feature of its
own. Vectors and output are fitted by stochastic gradient descent in numpy.

To score, a feature matters only by what its vector adds to the difference of
the two logits. A word's features fold into two numbers, their sum and their
count, and a document's score is a logistic function of the ratio of totals.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespark.llm.common import ROWS_AT_ONCE, map_arrow, texts_of
from carespark.llm.labelled import held_out, labelled_sample
from carespark.llm.subwords import WORD_CHARS, WordValues, summed_weights, word_features

PER_CLASS = 1500      # labelled documents of each label to learn from, at most
MAX_CHARS = 50_000    # longer ones are not learned from (all are scored)
BUCKETS = 1 << 17     # of hashed words and n-grams; one more for repeats
DIMENSIONS = 16
GRAMS = (2, 3)
EPOCHS = 12
RATE = 0.5
GOOD = 0.5


class Model:
    """What each feature adds to the logit difference, and the bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self.repeat = float(weights[BUCKETS])
        self.words = WordValues(self._values)

    def _values(self, words: list[str]) -> list[complex]:
        """A word's sum of weights, and its number of features as the imaginary part."""
        total, count = summed_weights(words, self.weights, GRAMS, BUCKETS)
        return (total + 1j * count).tolist()

    def scores(self, texts: list[str]) -> list[float]:
        """Each whole text's probability to be good."""
        rows = [t.split() for t in texts]
        value = self.words.of(rows)
        return [self._score(words, value) for words in rows]

    def score(self, text: str) -> float:
        return self.scores([text])[0]

    def _score(self, words: list[str], value: dict) -> float:
        total = np.fromiter(map(value.__getitem__, words), complex, len(words)).sum() if words else 0j
        repeats = sum(map(eq, words[1:], words))
        count = total.imag + repeats
        z = (total.real + repeats * self.repeat) / count + self.bias if count else self.bias
        return float(1 / (1 + np.exp(-z)))


def fit(texts: list[str], y: np.ndarray, weights: np.ndarray, seed: int = 7) -> Model:
    """Stochastic gradient descent over documents in shuffled order, the rate falling to zero.
    Without rows of both labels the model is constant: the share of good rows."""
    if not len(texts) or y.min() == y.max():
        share = min(max(float(y.mean()) if len(y) else 0.0, 1e-6), 1 - 1e-6)
        return Model(np.zeros(BUCKETS + 1), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    seen: dict[str, np.ndarray] = {}
    docs = []
    for text in texts:
        words = text.split()
        new = sorted(set(words).difference(seen))
        here = dict(zip(new, word_features(new, GRAMS, BUCKETS)))
        seen.update((w, f) for w, f in here.items() if len(w) <= WORD_CHARS)
        repeats = sum(map(eq, words[1:], words))
        parts = [here[w] if w in here else seen[w] for w in words]
        ids = np.concatenate([*parts, np.full(repeats, BUCKETS, np.int32)]) if words else np.empty(0, np.int32)
        u, n = np.unique(ids, return_counts=True)
        docs.append((u, (n / max(len(ids), 1))[:, None].astype(np.float32)))
    vectors = ((rng.random((BUCKETS + 1, DIMENSIONS)) - 0.5) / DIMENSIONS).astype(np.float32)
    out, bias = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2, np.float32)
    weights = weights / weights.mean()
    steps, step = EPOCHS * len(texts), 0
    for _ in range(EPOCHS):
        for d in rng.permutation(len(texts)):
            u, share = docs[d]
            rate = RATE * (1 - step / steps) * weights[d] ** 0.5
            step += 1
            hidden = (vectors[u] * share).sum(0)
            z = out @ hidden + bias
            p = np.exp(z - z.max())
            g = p / p.sum()
            g[int(y[d])] -= 1
            back = g @ out
            out -= np.float32(rate) * np.outer(g, hidden)
            bias -= np.float32(rate * 0.1) * g
            # each feature moves as if the average were its own, which fastens sparse features
            vectors[u] -= np.float32(rate * 20) * share * back
    return Model((vectors @ (out[1] - out[0])).astype(float), float(bias[1] - bias[0]))


SCHEMA = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Model:
    """Fit on a bounded sample of the labelled documents that are not held out."""
    return fit(*labelled_sample(docs, labels, "quality", per_class, max_chars))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for each row: the whole text's probability to be good. A null or empty
    text gets the bias alone; a null doc_id stays null; repeated rows give repeated results;
    further columns are not read; an empty table gives none."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                ids, texts = batch.slice(at, ROWS_AT_ONCE).columns
                yield pa.record_batch([ids, pa.array(m.scores(texts.to_pylist()), pa.float64())], schema=SCHEMA)

    return map_arrow(texts_of(docs), run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, **sample) -> DataFrame:
    """Scores of all documents by a model that learns from ``labels``: (doc_id, held_out, score, predicted)."""
    scored = score_documents(docs, learn(docs, labels, **sample))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= GOOD).cast("int").alias("predicted"))
