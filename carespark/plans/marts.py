"""Materialised marts and exports (MRT-10, SRC-11/13/15/16, P15).

- :func:`write_mart` overwrites only the partitions present in the new data
  (``partitionOverwriteMode=dynamic``), so a daily refresh rewrites the
  touched years, not the whole mart.
- :func:`staged_write` writes into a staging folder and renames it into
  place, so readers never see a half-written table.
- :func:`export_partitioned` writes facts partitioned by year; readers
  filtering on the year get partition pruning.
- :func:`diff_results` is the two-build check (``exceptAll`` both ways).
- Work folders live under the session's reliable checkpoint directory (a
  shared folder on a cluster), never a machine-local temp folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carespark.session import ensure_checkpoint_dir


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory, apart from the stages
    that :func:`carespark.session.purge_stages` may delete."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/carespark-work/{name}-{uuid.uuid4().hex[:12]}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_mart(df: DataFrame, path: str, partition_cols: list[str], *, mode: str = "dynamic") -> None:
    """Write a mart partitioned by ``partition_cols``.

    ``dynamic``: replace only the partitions present in ``df``; ``full``:
    replace the whole mart; ``append``: add files. Rows are first brought
    together by the layout columns, so a partition is a few files and not one
    per task; adaptive execution splits a partition that is too large for one.
    """
    w = df.hint("rebalance", *[F.col(c) for c in partition_cols]).write.partitionBy(*partition_cols)
    if mode == "append":
        w.mode("append").parquet(path)
    elif mode == "full":
        w.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    else:
        w.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def staged_write(df: DataFrame, path: str, partition_cols: list[str] | None = None) -> None:
    """Write to a staging folder, then swap it in with two renames."""
    spark = df.sparkSession
    stage = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex[:8]}"
    w = df.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(stage)
    fs, target = _fs(spark, path)
    _, staged = _fs(spark, stage)
    old = None
    if fs.exists(target):
        _, old = _fs(spark, f"{path.rstrip('/')}.old-{uuid.uuid4().hex[:8]}")
        fs.rename(target, old)
    fs.rename(staged, target)
    if old is not None:
        fs.delete(old, True)


def export_partitioned(df: DataFrame, path: str, year_col: str = "encounter_year") -> None:
    """SRC-15: Parquet export partitioned by year."""
    write_mart(df, path, [year_col], mode="full")


def diff_results(a: DataFrame, b: DataFrame) -> DataFrame:
    """SRC-16: rows only in ``a`` and rows only in ``b`` (multiset semantics)."""
    return a.exceptAll(b).withColumn("side", F.lit("only_in_a")).unionByName(
        b.exceptAll(a).withColumn("side", F.lit("only_in_b"))
    )


def records_json(df: DataFrame) -> DataFrame:
    """SRC-13: one JSON object per result row (export of a mart to records)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("record"))


def persist_star(
    tables: dict[str, DataFrame],
    database: str,
    location: str,
    *,
    buckets: int,
    mode: str = "overwrite",
) -> dict[str, DataFrame]:
    """P12: store the star schema co-partitioned by patient.

    Facts are partitioned by start year (pruning for year filters) and
    bucketed + sorted by ``patient_key``; ``dim_patient`` is bucketed the same
    way. Per-patient aggregates over a fact and joins of those aggregates to
    the patient dimension then need no shuffle: the bucketed scans already
    deliver ``hashpartitioning(patient_key, buckets)``. Tables are external
    (data under ``location``, a shared folder). Returns the tables as read back.
    """
    spark = next(iter(tables.values())).sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    out = {}
    for name, df in tables.items():
        w = df
        if name.startswith("fact_"):
            w = w.withColumn("start_year", (F.col("start_date_key") / 10000).cast("int"))
            # a task holds one bucket: files = buckets x years, not tasks x buckets x years
            writer = w.repartition(buckets, "patient_key").write.mode(mode).partitionBy("start_year").bucketBy(buckets, "patient_key").sortBy(
                "patient_key", "start_date_key"
            )
        elif name == "dim_patient":
            writer = w.repartition(buckets, "patient_key").write.mode(mode).bucketBy(buckets, "patient_key").sortBy("patient_key")
        else:
            writer = w.write.mode(mode)
        writer.format("parquet").option("path", f"{location.rstrip('/')}/{name}").saveAsTable(
            f"{database}.{name}"
        )
        out[name] = spark.table(f"{database}.{name}")
    return out
