"""A bounded sample of labelled documents to fit a classifier on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32 of the id as text leaves 1 when divided by 3. A null id is none."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int):
    """(texts, labels, weights) of at most ``per_class`` documents of each label, none held out.

    Documents are taken in the order of a hash of their id, so the sample is the
    same whatever the layout; those of more than ``max_chars`` characters are not
    used. Weights restore the shares that the labels have among all labelled rows.
    Both bounds together bound what reaches the driver."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    known = docs.where(F.length(F.coalesce("text", F.lit(""))) <= max_chars).select("doc_id").join(known, "doc_id").distinct()
    share = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    ids = None
    for y in sorted(share):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        ids = part if ids is None else ids.unionAll(part)
    if ids is None:
        return [], np.empty(0), np.empty(0)
    ids = docs.sparkSession.createDataFrame(ids.toArrow())   # at most 2 * per_class rows
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id") \
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y")).orderBy("doc_id").toArrow()
    y = rows["y"].to_numpy().astype(float)
    n = {c: max(1, int((y == c).sum())) for c in (0, 1)}
    total = sum(share.values())
    weights = np.array([share[int(c)] / total / n[int(c)] for c in y])
    return rows["text"].to_pylist(), y, weights
