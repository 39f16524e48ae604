"""Builds that can be compared without reading them again (SRC-16).

A build is stored by (partition column, hash bucket of the key) with the *sums* of each folder:
its rows and the sum of its rows' digests, which does not depend on their order and counts
repeated rows. Two builds of one layout are compared by their sums, a small table; only the
folders whose sums differ are read, and only their rows are compared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carespark.plans.marts import diff_results

BUCKET = "_bucket"


def _digest(cols: list[str], half: int) -> Column:
    """60 bits of a row's digest as a number, so that 2^60 rows can be added up in a decimal."""
    row = F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)
    return F.conv(F.substring(row, 1 + 15 * half, 15), 16, 10).cast("decimal(38,0)")


def store_build(df: DataFrame, path: str, part: str, key: list[str], *, buckets: int) -> None:
    """Write a build and its folders' sums. ``buckets`` is the layout, the same for all builds that
    are to be compared. Rows of one key are in one bucket; a key that many rows share makes its bucket
    large, not a task: files of a bucket are split by size."""
    cols = df.columns
    placed = df.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
    placed.hint("rebalance", F.col(part), F.col(BUCKET)).write.mode("overwrite").partitionBy(part, BUCKET).parquet(f"{path}/rows")
    stored = read_build(df.sparkSession, path, df)
    stored.groupBy(part, BUCKET).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(_digest(cols, 0)).alias("low"), F.sum(_digest(cols, 1)).alias("high")) \
        .write.mode("overwrite").parquet(f"{path}/sums")


def read_build(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A stored build's rows, with the columns of ``like`` and the bucket."""
    schema = like.limit(0).withColumn(BUCKET, F.lit(0)).schema
    return spark.read.schema(schema).parquet(f"{path}/rows").select(*like.columns, BUCKET)


def differing_folders(spark: SparkSession, a: str, b: str, part: str) -> list[tuple]:
    """(partition value, bucket) of the folders that are not the same in both builds; as many as
    the layout has at most, whatever the rows."""
    left, right = (spark.read.parquet(f"{p}/sums").alias(n) for p, n in ((a, "l"), (b, "r")))
    on = F.col(f"l.{part}").eqNullSafe(F.col(f"r.{part}")) & (F.col(f"l.{BUCKET}") == F.col(f"r.{BUCKET}"))
    same = reduce(lambda x, y: x & y, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("rows", "low", "high")])
    # a folder of one side alone has no value of the other's bucket
    value = F.when(F.col(f"l.{BUCKET}").isNotNull(), F.col(f"l.{part}")).otherwise(F.col(f"r.{part}"))
    found = left.join(right, on, "full").where(~same).select(value.alias("p"), F.coalesce(f"l.{BUCKET}", f"r.{BUCKET}").alias("b"))
    return [(r.p, r.b) for r in found.collect()]


def diff_builds(spark: SparkSession, a: str, b: str, like: DataFrame, part: str) -> DataFrame:
    """Rows only in one of two builds (as diff_results: multisets, column ``side``), from the folders that differ."""
    by_part: dict = {}
    for value, bucket in differing_folders(spark, a, b, part):
        by_part.setdefault(value, []).append(bucket)
    wanted = reduce(lambda x, y: x | y, [F.col(part).eqNullSafe(F.lit(v)) & F.col(BUCKET).isin(found) for v, found in by_part.items()], F.lit(False))
    left, right = (read_build(spark, p, like).where(wanted).drop(BUCKET) for p in (a, b))
    return diff_results(left, right)
