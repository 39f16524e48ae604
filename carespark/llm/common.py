"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES: the ASCII white space of the contracts, [\x20\x09-\x0D].
ASCII_SPACE = "\x20\x09-\x0d"

# Rows that a worker turns into Python objects at a time. Very long texts then
# cost memory for a few rows only, not for a whole Arrow batch.
ROWS_AT_ONCE = 64


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more) -> DataFrame:
    """Only the columns that an operator needs; a null text counts as empty.
    ``more`` columns come after them."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"), *more)


def rows_of(batches: Iterable[pa.RecordBatch], at_once: int = ROWS_AT_ONCE) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples, converted in small slices."""
    for batch in batches:
        for at in range(0, batch.num_rows, at_once):
            part = batch.slice(at, at_once)
            yield from zip(*(c.to_pylist() for c in part.columns))


def release_memory() -> None:
    """Give back what a task no longer needs: reused Python workers would keep it, idle ones too."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def map_arrow(df: DataFrame, task, schema) -> DataFrame:
    """``mapInArrow``, after which the Python worker gives its memory back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        release_memory()

    return df.mapInArrow(run, schema)


class RowSink:
    """Collects output rows and hands them on as Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema, rows: int = 4096):
        self.schema, self.limit = schema, rows
        self.clear()

    def clear(self) -> None:
        self.cols = [[] for _ in self.schema]

    def add(self, *values) -> None:
        for col, v in zip(self.cols, values):
            col.append(v)

    @property
    def full(self) -> bool:
        return len(self.cols[0]) >= self.limit

    def batch(self) -> pa.RecordBatch:
        out = pa.record_batch([pa.array(c, f.type) for c, f in zip(self.cols, self.schema)], schema=self.schema)
        self.clear()
        return out


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage with a Parquet table in the shared checkpoint folder."""
    from carespark.session import stable_table

    return stable_table(df, f"llm-{name}")
