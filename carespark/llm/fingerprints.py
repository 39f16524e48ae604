"""Document fingerprints by Order MinHash.

A text's k-mers (code points) are numbered by occurrence, so repeated ones
differ. For each of the signature's hash functions the LEAST numbered k-mers of
the smallest hashes are selected, put back in text order, and the tuple is
hashed to one component. Two texts agree in a component only if they share the
selected k-mers in the same order, so the share of equal components falls with
edit distance, not only with the loss of common k-mers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespark.llm.common import RowSink, map_arrow, rows_of, texts_of, write_stage

K = 8
COMPONENTS = 64
LEAST = 2              # k-mers in a tuple
PIECE_BYTES = 1 << 19  # of hashes worked out at a time, so that they stay in cache

_GEN = np.random.Generator(np.random.PCG64(2019))
MULTIPLY = _GEN.integers(0, 1 << 32, COMPONENTS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
ADD = _GEN.integers(0, 1 << 32, COMPONENTS, dtype=np.uint64).astype(np.uint32)


def numbered_kmers(text: str, k: int = K) -> np.ndarray:
    """A 64-bit hash of the k-mer at each place together with how often it occurred before;
    a shorter text is one k-mer, an empty one has none."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if not len(c):
        return c
    if len(c) < k:
        h = np.array([int.from_bytes(hashlib.blake2b(c.tobytes(), digest_size=8).digest(), "big")], np.uint64)
    else:
        h, width, rest = c, 1, k
        acc, done = None, 0
        while rest:                     # by doubling: hashes of 1, 2, 4, ... code points
            if rest & 1:
                part = h[done:len(c) - k + done + 1]
                acc = part.copy() if acc is None else acc * np.uint64(0x9E3779B97F4A7C15) + part
                done += width
            rest >>= 1
            if rest:
                h = h[:-width] * np.uint64(0xC2B2AE3D27D4EB4F | width << 8) + h[width:]
                h ^= h >> np.uint64(29)
                width *= 2
        h = acc
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(31)
    n = len(h)
    # equal k-mers get numbers: sort (hash, place), number within runs
    bits = max(n - 1, 1).bit_length()
    if bits <= 20:
        packed = h >> np.uint64(bits) << np.uint64(bits) | np.arange(n, dtype=np.uint64)
        packed.sort()
        same = packed[1:] >> np.uint64(bits) == packed[:-1] >> np.uint64(bits)
        if not same.any():
            return h
        place = (packed & np.uint64((1 << bits) - 1)).astype(np.int64)
    else:
        place = np.argsort(h, kind="stable")
        same = h[place[1:]] == h[place[:-1]]
    start = np.concatenate(([0], np.flatnonzero(~same) + 1))
    number = np.arange(n) - np.repeat(start, np.diff(np.append(start, n)))
    again = number > 0
    h[place[again]] += number[again].astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    return h


def signature(text: str) -> np.ndarray:
    """COMPONENTS hashes of 16 bits; equal for equal texts."""
    h = numbered_kmers(text)
    n = len(h)
    if n < LEAST:
        seed = int(h[0]) if n else 0
        return ((MULTIPLY.astype(np.uint64) * np.uint64(seed & 0xFFFFFFFF | 1) + np.uint64(seed >> 32)) >> np.uint64(13)).astype(np.uint16)
    x = (h ^ h >> np.uint64(32)).astype(np.uint32)
    best = np.empty((COMPONENTS, LEAST), np.int64)
    step = max(1, PIECE_BYTES // (4 * n))
    for at in range(0, COMPONENTS, step):
        v = x * MULTIPLY[at:at + step, None]
        v += ADD[at:at + step, None]
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x2C1B3C6D)
        v ^= v >> np.uint32(13)
        rows = np.arange(len(v))
        for j in range(LEAST):
            m = v.argmin(1)
            best[at:at + step, j] = m
            v[rows, m] = np.uint32(0xFFFFFFFF)
    best.sort(1)                        # text order
    out = np.zeros(COMPONENTS, np.uint64)
    for j in range(LEAST):
        out = (out ^ h[best[:, j]]) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(28)
    return (out >> np.uint64(40)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The text with its last quarter (rounded down) replaced by as many first code points of the next one, or all."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


ROWS = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.binary()), ("fingerprint", pa.binary()),
                  ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
                  ("part", pa.int32()), ("text", pa.string())])
ROWS_DDL = ("doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, "
            "near_next double, part int, text string")


def compared(doc_id, text: str, own: np.ndarray, following: str, theirs: np.ndarray) -> tuple:
    """A finished row; ``own`` and ``theirs`` are the signatures of the text and of the next one."""
    e = edited(text, following)
    s = own if e == text else signature(e)
    return (doc_id, len(text), hashlib.sha256(e.encode("utf-8", "surrogatepass")).digest(), own.tobytes(), s.tobytes(),
            likeness(own, s), likeness(own, theirs), None, None)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Finished rows of a sorted partition. Its first and its last row come with their texts as well,
    marked by the partition: the last one's next document begins another partition."""
    part, sink, before, first = TaskContext.get().partitionId(), RowSink(ROWS, 512), None, None
    for doc_id, text in rows_of(batches):
        s = signature(text)
        if before is None:
            first = (doc_id, text)
        else:
            sink.add(*compared(*before, text, s))
        before = (doc_id, text, s)
        if sink.full:
            yield sink.batch()
    if before is not None:
        sink.add(first[0], 0, *[None] * 5, 2 * part, first[1])
        sink.add(before[0], 0, *[None] * 5, 2 * part + 1, before[1])
    yield sink.batch()


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sink = RowSink(ROWS, 64)
    for doc_id, text, following in rows_of(batches, 1):
        sink.add(*compared(doc_id, text, signature(text), following, signature(following)))
        if sink.full:
            yield sink.batch()
    yield sink.batch()


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited form, which ends in the beginning of the next document.

    Returns a row for each input row: (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next); fingerprints are hex, components of 16 bits. The next document is the one that
    follows by (doc_id, text), a null doc_id coming first; after the last comes the first, which may be the
    same one. A null text counts as empty; further columns are not read; an empty table gives none.

    The texts are range-partitioned by doc_id once and each partition is read in order. One row of each
    partition waits for the first of the next; these rows, two a partition, are matched on partition numbers."""
    d = texts_of(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows = write_stage(map_arrow(d, _neighbours, ROWS_DDL), "neighbours")
    edge = rows.where("part is not null").select("part", "doc_id", "text")
    # places of the partitions that have rows, in order; only their numbers, no texts, are put in line
    places = edge.where("part % 2 = 1").select("part")
    # each with the one after it, the last with the first: pairs before the explode, whose rows would each carry all
    line = places.groupBy().agg(F.sort_array(F.collect_list("part")).alias("all"))
    following = F.concat(F.slice("all", F.lit(2), F.size("all")), F.slice("all", 1, 1))
    order = line.select(F.explode(F.arrays_zip(F.col("all").alias("last"), following.alias("next"))).alias("p")) \
        .select("p.last", (F.col("p.next") - 1).alias("first"))
    last = edge.join(order, F.col("part") == F.col("last")).select("first", "doc_id", "text")
    first = edge.where("part % 2 = 0").select(F.col("part").alias("first"), F.col("text").alias("following"))
    rest = map_arrow(last.join(first, "first").select("doc_id", "text", "following"), _finish, ROWS_DDL)
    return rows.where("part is null").unionAll(rest).select(
        "doc_id", "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"), F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")
