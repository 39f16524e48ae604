"""Values at given ranks without sorting (AGG-08, WIN-05, SRT-02, SURVEY §4 P9).

Sorting all rows to read a few of them moves and stores every row. Here the range in which
a wanted value lies is narrowed by counting: an aggregate counts the values of each range in
BINS equal parts, with the least and greatest value of each; the part that holds the wanted
rank is the next range. Each pass is one scan with a map-side aggregate whose result has at
most BINS rows per wanted rank. A range of one distinct value is an answer; a range of at most
FEW rows is settled by counting its distinct values. Ranges shrink by the factor BINS, so
10^11 rows need three passes, and a value that a third of all rows share ends its range at once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carespark.session import stable_table

BINS = 4096
FEW = 20_000
LOCAL_ROWS = 10_000     # of a pass's result that may pass the driver; more are written


def _same(cols: list[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in cols], F.lit(True))


def _small(df: DataFrame, name: str, hinted: bool = True) -> DataFrame:
    """A pass's result, computed once: through the driver if it is small, else as a written table.
    ``hinted``: a small one is broadcast in joins."""
    head = df.limit(LOCAL_ROWS + 1).toArrow()
    if head.num_rows <= LOCAL_ROWS:
        local = df.sparkSession.createDataFrame(head, schema=df.schema)
        return F.broadcast(local) if hinted else local
    return stable_table(df, name)


def _part(value: Column, floating: bool) -> Column:
    """Which of BINS parts of [lo, hi] holds a value: never less for a greater one. Infinite values
    and NaN, which comes last, have parts of their own."""
    # halves, so that the width of all doubles is a double
    lo, hi, v = (c.cast("double") / 2 if floating else c for c in (F.col("lo"), F.col("hi"), value))
    width = (hi - lo).cast("double")
    share = F.when(width > 0, (v - lo).cast("double") / width).otherwise(0.0)
    inside = F.least(F.floor(share * BINS), F.lit(BINS - 1))
    d = value.cast("double")
    return F.when(F.isnan(d), BINS + 1).when(d == float("inf"), BINS).when(d == float("-inf"), -1).otherwise(inside).cast("int")


def values_at(df: DataFrame, group_cols: list[str], value: str, wanted) -> tuple[DataFrame, DataFrame]:
    """Values at ranks of each group's ascending values, NULLs left out.

    ``wanted(n)`` gives an array of ranks, from 0, for a group of n values. Returns rows
    (group, rank, value) and (group, n). Values are a numeric column; the range of a pass is
    worked out in its own type, so that equal doubles of different long or decimal values
    are told apart once a range is narrow."""
    if not group_cols:      # a constant group
        picked, sizes = values_at(df.select(F.lit(0).alias("_g"), value), ["_g"], value, wanted)
        return picked.drop("_g"), sizes.drop("_g")
    rows = df.select(*group_cols, F.col(value).alias("_v")).where(F.col("_v").isNotNull())
    if dict(rows.dtypes)["_v"] in ("tinyint", "smallint", "int", "bigint"):
        rows = rows.withColumn("_v", F.col("_v").cast("decimal(20,0)"))     # differences cannot overflow
    finite = ~F.isnan(F.col("_v").cast("double")) & (F.abs(F.col("_v").cast("double")) != float("inf"))
    sizes = _small(rows.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(finite, F.col("_v"))).alias("lo"), F.max(F.when(finite, F.col("_v"))).alias("hi"),
        F.min("_v").alias("_least"), F.max("_v").alias("_most")), "sizes", hinted=False)
    # rank: the one asked for; at: the same within [least, most]; held: how many values lie there
    todo = sizes.select(*group_cols, F.explode(F.array_distinct(wanted(F.col("n")).cast("array<bigint>"))).alias("rank"), "lo", "hi",
                        F.col("_least").alias("least"), F.col("_most").alias("most"), F.col("n").alias("held")).withColumn("at", F.col("rank"))
    todo = _small(todo, "ranges")
    left = F.sum(F.when((F.col("held") > FEW) & ~F.col("least").eqNullSafe(F.col("most")), F.col("held")))
    held, before = todo.agg(left).first()[0], None
    while held and held != before:      # a range of neighbouring doubles cannot get narrower
        todo = _small(_narrowed(rows, todo, group_cols), "ranges")
        held, before = todo.agg(left).first()[0], held
    return _settled(rows, todo, group_cols).withColumnRenamed("_v", value), sizes.select(*group_cols, "n")


def _in_ranges(rows: DataFrame, ranges: DataFrame, group_cols: list[str]) -> DataFrame:
    """Values beside each range of their group that holds them."""
    r = ranges.select(*[F.col(c).alias(f"_r_{c}") for c in group_cols], "rank", "lo", "hi", "least", "most", "at")
    return rows.join(r, _same(group_cols, "_r_") & F.col("_v").between(F.col("least"), F.col("most"))).drop(*[f"_r_{c}" for c in group_cols])


def _narrowed(rows: DataFrame, todo: DataFrame, group_cols: list[str]) -> DataFrame:
    open_ = (F.col("held") > FEW) & ~F.col("least").eqNullSafe(F.col("most"))
    v = F.col("_v")
    parts = _in_ranges(rows, todo.where(open_), group_cols).groupBy(*group_cols, "rank", "at", _part(v, dict(rows.dtypes)["_v"] in ("float", "double")).alias("part")).agg(
        F.count(F.lit(1)).alias("held"), F.min(v).alias("least"), F.max(v).alias("most"))
    # at most BINS + 3 rows a range
    up_to = F.sum("held").over(Window.partitionBy(*group_cols, "rank").orderBy("part"))
    found = parts.withColumn("_up", up_to).where((F.col("at") < F.col("_up")) & (F.col("at") >= F.col("_up") - F.col("held")))
    found = found.select(*group_cols, "rank", F.col("least").alias("lo"), F.col("most").alias("hi"), "least", "most", "held",
                         (F.col("at") - (F.col("_up") - F.col("held"))).alias("at"))
    return todo.where(~open_).unionByName(found)


def _settled(rows: DataFrame, todo: DataFrame, group_cols: list[str]) -> DataFrame:
    same = F.col("least").eqNullSafe(F.col("most"))
    done = todo.where(same).select(*group_cols, "rank", F.col("least").alias("_v"))
    counted = _in_ranges(rows, todo.where(~same), group_cols).groupBy(*group_cols, "rank", "at", "_v").agg(F.count(F.lit(1)).alias("_c"))
    # at most FEW rows a range
    up_to = F.sum("_c").over(Window.partitionBy(*group_cols, "rank").orderBy("_v"))
    found = counted.withColumn("_up", up_to).where((F.col("at") < F.col("_up")) & (F.col("at") >= F.col("_up") - F.col("_c")))
    return done.unionByName(found.select(*group_cols, "rank", "_v"))


def top_rows(df: DataFrame, value: str, key: str, n_top) -> Column:
    """A condition that holds for the first ``n_top(n)`` of the n rows by ``value`` descending, NULLs
    last, then by the unique ``key`` ascending, NULL first. A few scalars reach the driver; no row is numbered.

    Ties at the last value are split by key: a numeric key by selection like the value, another
    one by numbering the tied rows alone."""
    n, n_null = df.agg(F.count(F.lit(1)), F.count(F.when(F.col(value).isNull(), 1))).first()
    top = min(n, n_top(n))
    if top <= 0:
        return F.lit(False)
    if top <= n - n_null:
        picked, _ = values_at(df, [], value, lambda count: F.array(count - top))
        edge = picked.first()[value]
        above = F.coalesce(F.col(value) > F.lit(edge), F.lit(False))
        if isinstance(edge, float) and edge != edge:
            above = F.lit(False)
        tied = F.col(value).eqNullSafe(F.lit(edge))
    else:
        above, tied = F.col(value).isNotNull(), F.col(value).isNull()
    n_above, n_tied, n_nokey = df.agg(F.count(F.when(above, 1)), F.count(F.when(tied, 1)), F.count(F.when(tied & F.col(key).isNull(), 1))).first()
    left = top - n_above
    if left >= n_tied:
        return above | tied
    if left <= n_nokey:
        return above | (tied & F.col(key).isNull() & F.lit(left > 0))
    ties, rank = df.where(tied & F.col(key).isNotNull()).select(key), left - n_nokey
    if dict(ties.dtypes)[key] == "string":
        from carespark.operators.ordered import global_row_number

        last = global_row_number(ties, [key], "_n").where(F.col("_n") == rank).first()[key]
    else:
        last = values_at(ties, [], key, lambda count: F.array(F.lit(rank - 1)))[0].first()[key]
    return above | (tied & (F.col(key).isNull() | (F.col(key) <= F.lit(last))))
