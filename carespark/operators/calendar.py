"""Calendar dimension (GEN-01, STR-01) and calendar joins (JOI-01/02).

The calendar is generated with ``spark.range`` (distributed, one row per
day) rather than a driver-side list; its size is fixed by the date range
(11,323 rows for 2000..2030), which is what makes broadcasting it safe.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carespark import codes
from carespark.functions.columns import date_key, date_parts

# A calendar wider than this is refused for broadcast (rows): ~275 years.
MAX_BROADCAST_CALENDAR_DAYS = 100_000


def calendar_dim(
    spark: SparkSession, calendar: tuple[str, str] = codes.REFERENCE_CALENDAR
) -> DataFrame:
    """``dim_date``: date_key, full_date, year, month, day, quarter, day_of_week (0=Sun)."""
    start = dt.date.fromisoformat(calendar[0])
    end = dt.date.fromisoformat(calendar[1])
    n = (end - start).days + 1
    d = F.date_add(F.to_date(F.lit(calendar[0])), F.col("id").cast("int"))
    return spark.range(0, n).select(d.alias("full_date")).select(
        date_key("full_date").alias("date_key"), "full_date", *date_parts("full_date")
    )


def date_range(df: DataFrame, *date_cols: str) -> tuple[str, str]:
    """First and last date of some columns as ISO text, the range of a calendar (one aggregate)."""
    lo, hi = df.agg(F.least(*[F.min(c) for c in date_cols]) if len(date_cols) > 1 else F.min(date_cols[0]),
                    F.greatest(*[F.max(c) for c in date_cols]) if len(date_cols) > 1 else F.max(date_cols[0])).first()
    if lo is None:
        raise ValueError("no dates to range over")
    return lo.isoformat(), hi.isoformat()


def small_enough(dim_date: DataFrame) -> bool:
    """Whether a calendar has few enough rows to broadcast: its rows are counted, stored ones included."""
    return dim_date.limit(MAX_BROADCAST_CALENDAR_DAYS + 1).count() <= MAX_BROADCAST_CALENDAR_DAYS


def join_calendar(
    fact: DataFrame,
    dim_date: DataFrame,
    key_col: str,
    prefix: str,
) -> DataFrame:
    """Inner join to the calendar on a date key; drops NULL/out-of-range keys.

    The calendar is broadcast only after its size is checked.
    """
    cal = dim_date.select(*[F.col(c).alias(f"{prefix}{c}") for c in dim_date.columns])
    if small_enough(dim_date):
        cal = F.broadcast(cal)
    return fact.join(cal, F.col(key_col) == F.col(f"{prefix}date_key"), "inner")
