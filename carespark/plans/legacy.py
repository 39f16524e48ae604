"""Legacy-lineage operators ([L] items of SURVEY §2): wide claim sources.

- :func:`unpivot_wide` — repeated code columns to long rows (GEN-02, STR-11);
  Spark's ``unpivot`` is an Expand, no shuffle.
- :func:`claim_line_union` — several claim facts as one (SET-02).
- :func:`patient_year_scd` — one row per patient per year, latest values (STR-10).
- :func:`cohort_rollup` — ROLLUP with grouping ids (AGG-14).
- :func:`rank_desc` — RANK() by a measure, distributed (WIN-06).
- :func:`next_year_high_cost` — next-year label from yearly cost (ML-12).
- :func:`read_claim_files` — several files per table, year from the name (SRC-17, SCL-27).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carespark.functions.columns import year_from_file_name
from carespark.operators.ordered import global_rank
from carespark.operators.percentiles import exact_percentiles
from carespark.session import stable_table


def unpivot_wide(
    df: DataFrame,
    id_cols: list[str],
    value_cols: list[str],
    *,
    slot_col: str = "slot",
    value_col: str = "code",
    drop_empty: bool = True,
) -> DataFrame:
    """Wide repeated columns -> (ids..., slot, value); blank/NULL values dropped."""
    cast = df.select(*id_cols, *[F.col(c).cast("string").alias(c) for c in value_cols])
    long = cast.unpivot(id_cols, value_cols, slot_col, value_col)
    if drop_empty:
        long = long.where(F.col(value_col).isNotNull() & (F.trim(F.col(value_col)) != ""))
    return long


def code_dictionary_from_wide(long: DataFrame, value_col: str = "code") -> DataFrame:
    """STR-11: distinct codes seen in any slot, with how many rows use each."""
    return long.groupBy(value_col).agg(F.count(F.lit(1)).alias("uses"))


def claim_line_union(frames: dict[str, DataFrame]) -> DataFrame:
    """SET-02: UNION ALL by name of several claim facts, tagged with ``claim_type``."""
    tagged = [df.withColumn("claim_type", F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def patient_year_scd(
    encounters: DataFrame,
    *,
    value_cols: list[str],
    date_col: str = "start_date",
    tiebreak: str = "encounter_key",
) -> DataFrame:
    """STR-10: per (patient, year) the latest row's values, plus counts.

    ``max_by`` over a (date, key) struct is a partial aggregate — no window,
    so a patient with many rows is combined map-side.
    """
    order = F.struct(F.col(date_col), F.col(tiebreak))
    return encounters.groupBy("patient_key", F.year(date_col).alias("year")).agg(
        F.count(F.lit(1)).alias("rows_in_year"),
        *[F.max_by(F.col(c), order).alias(f"latest_{c}") for c in value_cols],
    )


def cohort_rollup(patient_attrs: DataFrame, dims: list[str], flags: list[str], count_col: str) -> DataFrame:
    """AGG-14: ROLLUP over cohort attributes with comorbidity counts."""
    return patient_attrs.rollup(*dims).agg(
        F.grouping_id().alias("grouping_id"),
        F.count(F.lit(1)).alias("patients"),
        *[F.sum(f).cast("long").alias(f"{f}_patients") for f in flags],
        F.sum(F.when(F.col(count_col) >= 2, 1).otherwise(0)).cast("long").alias("comorbid_patients"),
    )


def rank_desc(df: DataFrame, value_col: str, key_col: str, out: str = "rank") -> DataFrame:
    """WIN-06: SQL RANK() by ``value_col`` descending, without a single-task sort.

    One distributed numbering; the rank is the smallest row number of equal values (a BIGINT).
    """
    return global_rank(df, value_col, False, [key_col], out)


def next_year_high_cost(
    encounters: DataFrame, *, fraction: float = 0.25, cost_col: str = "total_claim_cost"
) -> DataFrame:
    """ML-12: per (patient, year) cost, next calendar year's cost and a label.

    Label 1 when the next year's cost is at or above that year's
    (1 - fraction) percentile of patient-year costs (exact percentile), else 0
    (including no activity next year).
    """
    py = encounters.groupBy("patient_key", F.year("start_date").alias("year")).agg(
        F.sum(cost_col).alias("year_cost")
    )
    py = stable_table(py, "patient-years")  # read three times below
    cut = exact_percentiles(py, ["year"], "year_cost", {"cut": 1.0 - fraction})
    nxt = py.select(
        "patient_key",
        (F.col("year") - 1).alias("year"),
        F.col("year_cost").alias("next_year_cost"),
        F.col("year").alias("_next_year"),
    )
    j = py.join(nxt, ["patient_key", "year"], "left").join(
        cut.withColumnRenamed("year", "_next_year"), "_next_year", "left"
    )
    label = F.when(
        F.col("next_year_cost").isNotNull() & (F.col("next_year_cost").cast("double") >= F.col("cut")), 1
    ).otherwise(0)
    return j.select(
        "patient_key", "year", F.col("year_cost").cast("double").alias("year_cost"),
        F.col("next_year_cost").cast("double").alias("next_year_cost"),
        label.alias("next_year_high_cost"),
    )


def read_claim_files(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """SRC-17/SCL-27: several CSV parts of one table, bound by header name,
    tagged with the source file and the year found in its name."""
    from carespark.sources.csv_ingest import read_raw_csv

    good, _ = read_raw_csv(spark, paths, columns)
    return good.withColumn("file_year", year_from_file_name(F.col("_source_file")))
