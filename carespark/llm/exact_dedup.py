"""Exact duplicates by content sort.

The normalised texts are put in order across the cluster: sampled splitters
range-partition the rows by (first characters, hash, doc_id), and an external
sort within each partition compares whole normalised texts. Equal texts are then
neighbours, compared in full one after the other, and the first of them has the
smallest doc_id. As doc_id is part of the splitters, a text that holds a large
share of the rows spreads over many partitions; only runs at a partition's edge
can go on in the next one, and these are added up by digest afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from carespark.llm.common import map_arrow, rows_of, write_stage

PREFIX_CHARS = 32  # of the text in a splitter, so that sampled splitters stay small


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; single spaces need no replacing."""
    return F.regexp_replace(text, "[\\x09-\\x0D][\\x20\\x09-\\x0D]*|\\x20[\\x20\\x09-\\x0D]+", " ")


def _body(text: Column) -> Column:
    return normalised(F.coalesce(text, F.lit("")))


class RunWriter:
    """Output columns of one partition. Rows wait until their run is known to have ended."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.runs, self.edge = schema, [], True
        self.out = [[] for _ in schema]

    def end_key(self, edge: bool) -> None:
        """The runs of a splitter key have ended; ``edge``: neighbours in another partition may share it."""
        for digest, ids, first in self.runs:
            keep, n = ids[0], len(ids)
            cols = [ids, [keep] * n, [n] * n, [True] + [False] * (n - 1), [edge] * n, [digest] * n]
            if first is not None:
                cols.append([first] + [None] * (n - 1))
            for out, col in zip(self.out, cols):
                out += col
        self.runs = []

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.out[0]) >= least:
            for at in range(0, len(self.out[0]), 4096):
                yield pa.record_batch([pa.array(c[at:at + 4096], f.type) for c, f in zip(self.out, self.schema)],
                                      schema=self.schema)
            self.out = [[] for _ in self.schema]


def _compare_task(schema: pa.Schema, row_at: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = RunWriter(schema)
        key, before, first_key = None, None, True
        for values in rows_of(batches):
            doc_id, text, prefix, h = values[:4]
            if (prefix, h) != key:
                if key is not None:
                    w.end_key(first_key)
                    first_key = False
                    yield from w.batches(2048)
                key, before = (prefix, h), None
            if text == before:          # neighbours, compared in full
                w.runs[-1][1].append(doc_id)
            else:
                before = text
                w.runs.append((hashlib.sha256(text.encode()).hexdigest(), [doc_id],
                               values[row_at] if row_at is not None else None))
        w.end_key(True)
        yield from w.batches(1)

    return run


def exact_duplicates(docs: DataFrame, keep_rows: bool = False) -> DataFrame:
    """Groups of texts that are equal after white space is normalised.

    Returns a row for each input row: (doc_id, keep_id, group_size, kept,
    text_sha256). With ``keep_rows``, instead the rows that stay, with the
    columns of ``docs``. A null text counts as empty and so equals an empty one.
    A null doc_id comes after all others: it stays only if its group has no
    other, and keep_id is then null. Rows that repeat a doc_id and a text are one
    group; exactly one of them stays. Columns of any name may be present; an
    empty table gives none."""
    whole_row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    d = docs.select(F.col("doc_id").cast("long").alias("id"), _body(F.col("text")).alias("body"),
                    *([whole_row] if keep_rows else []))
    # with whole rows only these travel: the normalised text is made again after the exchange
    d = d.select("id", F.substring("body", 1, PREFIX_CHARS).alias("prefix"), F.xxhash64("body").alias("h"),
                 "row" if keep_rows else "body")
    by_id = F.col("id").asc_nulls_last()
    d = d.repartitionByRange("prefix", "h", by_id)
    if keep_rows:
        d = d.withColumn("body", _body(F.col("row.text")))
    d = d.sortWithinPartitions("prefix", "h", "body", by_id).select("id", "body", "prefix", "h", *(["row"] if keep_rows else []))
    out = T.StructType.fromDDL("doc_id long, keep_id long, group_size long, kept boolean, edge boolean, text_sha256 string")
    if keep_rows:
        out.add("row", d.schema["row"].dataType)
    runs = write_stage(map_arrow(d, _compare_task(to_arrow_schema(out), 4 if keep_rows else None), out), "runs")
    edges = runs.where("edge").groupBy("text_sha256").agg(F.min("doc_id").alias("low"), F.count("*").alias("n"))
    rest = ["row"] if keep_rows else []
    inner = runs.where("not edge").select("doc_id", "keep_id", "group_size", "kept", "text_sha256", *rest)
    joined = runs.where("edge" if not keep_rows else "edge and kept").join(edges, "text_sha256").select(
        "doc_id", F.col("low").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("kept") & F.col("doc_id").eqNullSafe(F.col("low"))).alias("kept"), "text_sha256", *rest)
    whole = inner.unionAll(joined)
    return whole.where("kept").select("row.*") if keep_rows else whole
