"""Exact continuous percentiles at scale (AGG-08, SURVEY §4 P9).

``percentile_cont`` as an aggregate keeps a value->count map per group; with
one year holding hundreds of millions of distinct costs that map is one huge
object in one task. Here the two values around each requested position are found
by counting (:mod:`carespark.operators.selection`): no sort, no stage of the rows.
``h = p * (n - 1)``, result ``v[floor h] + (h - floor h) * (v[ceil h] - v[floor h])``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespark.operators.selection import values_at


def exact_percentiles(
    df: DataFrame,
    group_cols: list[str],
    value_col: str,
    probs: dict[str, float],
) -> DataFrame:
    """One row per group with one DOUBLE column per entry of ``probs``.

    NULL values are ignored (SQL semantics). ``probs`` maps output name -> p.
    """
    global_only = not group_cols
    if global_only:  # a constant group
        df = df.withColumn("_g", F.lit(0))
        group_cols = ["_g"]
    vals = df.select(*group_cols, F.col(value_col).alias("_value"))

    def place(p, n):
        return F.lit(float(p)) * (n - 1)

    def wanted(n):
        return F.array(*[f(place(p, n)).cast("long") for p in probs.values() for f in (F.floor, F.ceil)])

    picked, sizes = values_at(vals, group_cols, "_value", wanted)
    # values meet the percentiles that want them on (group, rank), a few rows per group
    def here(rank):
        return F.struct(*group_cols, rank.alias("rank")).alias("_at")

    names = F.array(*[F.struct(F.lit(i).alias("i"), f(place(p, F.col("n"))).cast("long").alias("rank"), F.lit(high).alias("high"))
                      for i, p in enumerate(probs.values()) for f, high in ((F.floor, False), (F.ceil, True))])
    ends = sizes.select(*group_cols, "n", F.inline(names)).select(here(F.col("rank")), *group_cols, "n", "i", "high")
    found = picked.select(here(F.col("rank").cast("long")), F.col("_value").cast("double").alias("_value")).join(ends, "_at")
    out = []
    for i, (name, p) in enumerate(probs.items()):
        h = place(p, F.max("n"))
        lo = F.max(F.when((F.col("i") == i) & ~F.col("high"), F.col("_value")))
        hi = F.max(F.when((F.col("i") == i) & F.col("high"), F.col("_value")))
        out.append((lo + (h - F.floor(h)) * (hi - lo)).alias(name))
    res = found.groupBy(*group_cols).agg(*out)
    return res.drop("_g") if global_only else res
