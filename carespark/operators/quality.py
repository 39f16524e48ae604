"""Data-quality operators replacing database constraints (STR-09).

Spark enforces no primary, unique or foreign keys. Each check returns the
violating rows as a DataFrame (empty = pass); :func:`enforce` applies a
policy: ``fail`` raises, ``quarantine`` splits good rows from bad ones so
one bad row does not abort the whole load (the reference engine rejects
the entire insert).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ConstraintViolation(Exception):
    pass


def check_unique(df: DataFrame, key_cols: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count (partial aggregate)."""
    return (
        df.groupBy(*key_cols)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows where any of ``cols`` is NULL, tagged with the first NULL column."""
    first_null = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return df.where(first_null.isNotNull()).withColumn("null_column", first_null)


def check_fk(
    fact: DataFrame, fk_col: str, dim: DataFrame, dim_key: str
) -> DataFrame:
    """Fact rows whose non-NULL foreign key has no row in the dimension.

    A ``left_anti`` join; the dimension side is de-duplicated first (the
    planner then co-partitions both sides on the key).
    """
    keys = dim.select(F.col(dim_key).alias("_fk")).distinct()
    return fact.where(F.col(fk_col).isNotNull()).join(
        keys, F.col(fk_col) == F.col("_fk"), "left_anti"
    )


def fk_violations(fact: DataFrame, key_col: str, checks: dict[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """(constraint_name, row_key, bad_value) of several foreign keys in one pass over the facts.

    ``checks`` maps a constraint to (foreign key column, dimension, its key). Each
    dimension is left-joined as a set of keys, and the keys that found none are
    stacked."""
    d, found = fact, []
    for i, (name, (col, dim, dim_key)) in enumerate(checks.items()):
        keys = dim.select(F.col(dim_key).alias(f"_dim_{i}")).distinct()
        d = d.join(keys, F.col(col) == F.col(f"_dim_{i}"), "left")
        bad = F.col(col).isNotNull() & F.col(f"_dim_{i}").isNull()
        found.append(F.when(bad, F.struct(F.lit(name).alias("constraint_name"), F.col(col).cast("string").alias("bad_value"))))
    return d.select(F.col(key_col).cast("long").alias("row_key"), F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("v")) \
        .select("v.constraint_name", "row_key", "v.bad_value")


def enforce(df: DataFrame, bad: DataFrame, key_cols: list[str], policy: str = "quarantine"):
    """Apply a constraint policy. Returns ``(good, quarantined)``.

    ``fail`` raises when any violation exists (one bounded ``limit(1)``
    probe); ``quarantine`` removes violating keys with a null-safe anti-join.
    """
    if policy == "fail":
        if bad.limit(1).count():
            raise ConstraintViolation(f"constraint violated on {key_cols}")
        return df, bad.limit(0)
    bk = bad.select(*[F.col(k).alias(f"_b_{k}") for k in key_cols]).distinct()
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(bk[f"_b_{k}"]) for k in key_cols])
    good = df.join(bk, cond, "left_anti")
    quarantined = df.join(bk, cond, "left_semi")
    return good, quarantined


def orphan_report(tables: dict[str, DataFrame], key_cols: tuple[str, ...] = ("patient_key", "encounter_key", "provider_key")) -> DataFrame:
    """P13: per fact table and foreign key, how many rows carry a NULL key
    (orphans kept by the left lookups). One global aggregate per table."""
    parts = []
    for name, df in tables.items():
        if not name.startswith("fact_"):
            continue
        for k in key_cols:
            if k in df.columns:
                parts.append(
                    df.agg(
                        F.count(F.lit(1)).alias("rows"),
                        F.count_if(F.col(k).isNull()).alias("orphan_rows"),
                    ).select(F.lit(name).alias("table_name"), F.lit(k).alias("key_column"), "rows", "orphan_rows")
                )
    return reduce(lambda a, b: a.unionByName(b), parts)
