"""Skew-safe ordered operators: LAG and ROW_NUMBER within groups, global ranks.

``Window.partitionBy(key)`` sends every row of one key to one task. When one
patient (or the NULL orphan key, or one year) holds a third of all rows that
task holds a third of the data. These operators instead **range-partition on
the full sort key** (group columns + order columns), so a hot group is split
over as many partitions as its size needs, and write the sorted rows once to
the shared checkpoint folder with their partition number and place in it
(stable input for everything below; survives executor loss).

Everything is DataFrame expressions on the JVM. What crosses a partition
boundary is small: counts, group starts and last rows, one row per partition
(or per partition and group), joined back on the *partition number* — never on
the group key, so no exchange gathers a hot group again.

Callers should pass a total order (add a unique tie-breaker) so results are
reproducible; the written stage makes them consistent even without one.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carespark.session import stable_table

_PID, _POS, _GRN = "_pid", "_pos", "_grn"
_MID_SHIFT = 33  # monotonically_increasing_id = (partition id << 33) + row index


def _sort_exprs(group_cols: list[str], order_cols: list[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in group_cols] + [
        (F.col(c).asc_nulls_first() if isinstance(c, str) else c) for c in order_cols
    ]


def _sorted_stage(df: DataFrame, sort_exprs: list[Column], num_partitions: int | None) -> tuple[DataFrame, DataFrame, int]:
    """``df`` in global order as a written table with partition number, place in the partition
    (from 0) and global row number (from 1); the partitions' table; the row count.

    Partitions are sized by adaptive execution unless ``num_partitions`` is given."""
    spark = df.sparkSession
    ranged = df.repartitionByRange(num_partitions, *sort_exprs) if num_partitions else df.repartitionByRange(*sort_exprs)
    mid = F.monotonically_increasing_id()
    ck = stable_table(
        ranged.sortWithinPartitions(*sort_exprs)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_POS, mid - F.shiftleft(F.spark_partition_id().cast("long"), _MID_SHIFT)),
        "ordered",
    )
    # One row per partition, whatever the data: fetched to number the rows.
    counts = sorted((r[0], int(r[1])) for r in ck.groupBy(_PID).agg(F.count(F.lit(1))).collect())
    rows, before, run = [], None, 0
    for pid, n in counts:
        rows.append((pid, before, run, n))
        before, run = pid, run + n
    # from an Arrow table: a local relation, whose broadcast needs no job
    kinds = [(_PID, pa.int32()), ("_before", pa.int32()), ("_off", pa.int64()), ("_n", pa.int64())]
    parts = spark.createDataFrame(pa.table({n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(kinds)}))
    numbered = ck.join(F.broadcast(parts.select(_PID, "_off")), _PID).withColumn(_GRN, F.col("_off") + F.col(_POS) + 1).drop("_off")
    return numbered, parts, run


def _same(left: list[Column], right: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in zip(left, right)], F.lit(True))


def global_row_number(
    df: DataFrame,
    order_cols: list[str | Column],
    out: str = "row_number",
    num_partitions: int | None = None,
    with_count: bool = False,
):
    """ROW_NUMBER() OVER (ORDER BY order_cols), distributed and JVM-only.

    ``with_count=True`` returns ``(frame, total_rows)`` — the total is known
    from the partition counts, so callers need no extra counting pass.
    """
    g, _, n = _sorted_stage(df, _sort_exprs([], order_cols), num_partitions)
    numbered = g.withColumnRenamed(_GRN, out).select(*df.columns, out)
    return (numbered, n) if with_count else numbered


def group_starts(numbered: DataFrame, group_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """Per (partition, group) and per group: the group's first global row number and its size.

    The second is one row per group; the first has a row for each group in each
    partition, so joining rows to it on (partition, group) spreads a hot group
    like the partitions do."""
    here = numbered.groupBy(_PID, *group_cols).agg(F.min(_GRN).alias("_lo"), F.count(F.lit(1)).alias("_c"))
    whole = here.groupBy(*group_cols).agg(F.min("_lo").alias("_gstart"), F.sum("_c").alias("_gcount"))
    w = whole.select(*[F.col(c).alias(f"_w_{c}") for c in group_cols], "_gstart", "_gcount")
    cond = _same([F.col(c) for c in group_cols], [F.col(f"_w_{c}") for c in group_cols])
    placed = here.join(w, cond).select(
        F.col(_PID).alias("_s_pid"), *[F.col(c).alias(f"_s_{c}") for c in group_cols], "_gstart", "_gcount")
    return placed, whole


def grouped_row_number(
    df: DataFrame,
    group_cols: list[str],
    order_cols: list[str | Column],
    out: str = "row_number",
    count_col: str | None = None,
    num_partitions: int | None = None,
    start_col: str | None = None,
):
    """ROW_NUMBER() OVER (PARTITION BY group ORDER BY order), skew-safe, JVM-only.

    Global row number over (group, order), minus the group's first global
    number. ``count_col`` also adds the group size, ``start_col`` the group's
    first global number. ``order_cols`` may carry the group's own order too.
    """
    if not group_cols:
        if count_col or start_col:
            raise ValueError("count_col and start_col need group columns")
        return global_row_number(df, order_cols, out, num_partitions)
    g, _, _ = _sorted_stage(df, _sort_exprs(group_cols, order_cols), num_partitions)
    placed, _ = group_starts(g, group_cols)
    j = g.join(placed, (F.col(_PID) == F.col("_s_pid")) & _same([F.col(c) for c in group_cols], [F.col(f"_s_{c}") for c in group_cols]))
    cols = [*[F.col(c) for c in df.columns], (F.col(_GRN) - F.col("_gstart") + 1).cast("long").alias(out)]
    if count_col:
        cols.append(F.col("_gcount").alias(count_col))
    if start_col:
        cols.append(F.col("_gstart").alias(start_col))
    return j.select(*cols)


def global_rank(df: DataFrame, value: str, ascending: bool, tie: list[str], out: str) -> DataFrame:
    """SQL RANK() by ``value``, NULLs last: the smallest global row number among equal values. One numbering."""
    v = F.col(value)
    order = [v.asc_nulls_last() if ascending else v.desc_nulls_last(), *[F.col(t).asc() for t in tie]]
    g, _, _ = _sorted_stage(df, order, None)
    placed, _ = group_starts(g, [value])
    j = g.join(placed, (F.col(_PID) == F.col("_s_pid")) & v.eqNullSafe(F.col(f"_s_{value}")))
    return j.select(*df.columns, F.col("_gstart").alias(out))


def ordered_scan(
    df: DataFrame,
    group_cols: list[str],
    order_cols: list[str | Column],
    lag: dict[str, str] | None = None,
    row_number: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Per group (ordered by ``order_cols``): previous row's values and/or row number.

    ``lag`` maps output column -> source column (LAG(source, 1) semantics,
    NULL on each group's first row). ``row_number`` names a 1-based
    ROW_NUMBER column. With no ``group_cols`` the row number is a global
    rank (distributed, no single-partition stage).

    LAG runs over each range partition, whose size does not depend on any group;
    a partition's first row looks at the last row of the partition before, found
    in a table of one row per partition. ``order_cols`` are column names sorted
    ascending, NULLs first (use :func:`pyspark.sql.functions.desc` style Columns
    for descending). Group columns compare NULL-equal, like SQL PARTITION BY.
    """
    lag = dict(lag or {})
    g, parts, _ = _sorted_stage(df, _sort_exprs(group_cols, order_cols), num_partitions)
    if lag:
        # one row per partition: its last row's group and values, given to the partition after it
        last = g.join(F.broadcast(parts), _PID).where(F.col(_POS) == F.col("_n") - 1).select(
            F.col(_PID).alias("_of"), *[F.col(c).alias(f"_ck_{c}") for c in group_cols],
            *[F.col(s).alias(f"_cv_{o}") for o, s in lag.items()])
        carry = parts.select(F.col(_PID).alias("_c_pid"), "_before").join(
            F.broadcast(last), F.col("_before") == F.col("_of")).drop("_of", "_before")
        w = Window.partitionBy(_PID).orderBy(_POS)
        g = g.withColumns({f"_pk_{c}": F.lag(c).over(w) for c in group_cols} | {f"_pv_{o}": F.lag(s).over(w) for o, s in lag.items()})
        g = g.join(F.broadcast(carry), F.col(_PID) == F.col("_c_pid"), "left")
        groups = [F.col(c) for c in group_cols]
        inside = (F.col(_POS) > 0) & _same(groups, [F.col(f"_pk_{c}") for c in group_cols])
        across = (F.col(_POS) == 0) & F.col("_c_pid").isNotNull() & _same(groups, [F.col(f"_ck_{c}") for c in group_cols])
        g = g.withColumns({o: F.when(inside, F.col(f"_pv_{o}")).when(across, F.col(f"_cv_{o}")) for o in lag})
    if row_number and group_cols:
        placed, _ = group_starts(g, group_cols)
        g = g.join(placed, (F.col(_PID) == F.col("_s_pid"))
                   & _same([F.col(c) for c in group_cols], [F.col(f"_s_{c}") for c in group_cols]))
        g = g.withColumn(row_number, (F.col(_GRN) - F.col("_gstart") + 1).cast("long"))
    elif row_number:
        g = g.withColumn(row_number, F.col(_GRN))
    return g.select(*df.columns, *lag, *([row_number] if row_number else []))


def rows_at(df: DataFrame, group_cols: list[str], value: str, wanted) -> tuple[DataFrame, DataFrame]:
    """Values at positions within ordered groups, without moving the ordered rows by group.

    ``wanted(n)`` gives an array of 1-based positions for a group of n rows. Returns
    ((group, position, value) rows, (group, n) rows). Positions become global row
    numbers, which are unique, and the rows are joined on those."""
    g, _, _ = _sorted_stage(df, _sort_exprs(group_cols, [value]), None)
    _, whole = group_starts(g, group_cols)
    places = whole.select(*[F.col(c) for c in group_cols], F.col("_gstart"), F.explode(F.array_distinct(wanted(F.col("_gcount")))).alias("position")) \
        .withColumn("_at", F.col("_gstart") + F.col("position") - 1)
    picked = g.select(F.col(_GRN).alias("_at"), F.col(value)).join(places, "_at").select(*group_cols, "position", value)
    return picked, whole.select(*group_cols, F.col("_gcount").alias("n"))


def ntile_from_rank(rank: Column, n: Column, buckets: int) -> Column:
    """NTILE(buckets) bucket of a 1-based rank among ``n`` rows (SQL semantics).

    The first ``n % buckets`` buckets hold one extra row.
    """
    q = F.floor(n / buckets)
    r = n % buckets
    big = r * (q + 1)
    return F.when(rank <= big, F.floor((rank - 1) / (q + 1)) + 1).otherwise(
        r + F.floor((rank - big - 1) / q) + 1
    ).cast("int")
