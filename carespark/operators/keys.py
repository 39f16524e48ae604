"""Surrogate keys and idempotent appends (WIN-04, JOI-06/07, JOI-10, P8).

- Keys are dense, deterministic (ordered by the natural key) and continue
  after the current maximum. Numbering uses the distributed global rank of
  :func:`global_row_number` — no ``Window.orderBy`` without partitioning, which
  would pull every row into one task.
- Insert-if-absent is a ``left_anti`` join on the natural key. A row whose key
  has a NULL part is known only by its whole content: it matches a stored row
  that is equal in every column, so unknown keys never merge distinct rows and a
  reload still inserts nothing. Duplicates of a key within a batch stay unless
  asked for; what a de-duplication removes is returned with a count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespark.operators.ordered import global_row_number


def max_key(existing: DataFrame | None, key_col: str) -> int:
    """JOI-10: current maximum surrogate key (0 when there is none).

    A one-row aggregate fetched as a single scalar.
    """
    if existing is None:
        return 0
    v = existing.agg(F.max(key_col)).first()[0]
    return int(v) if v is not None else 0


def assign_surrogate_keys(
    df: DataFrame,
    natural_key: list[str | Column],
    key_col: str,
    offset: int = 0,
) -> DataFrame:
    """Add ``key_col`` = offset + 1..n in natural-key order (distributed)."""
    ranked = global_row_number(df, natural_key, "_sk_rn")
    return ranked.withColumn(key_col, (F.col("_sk_rn") + F.lit(int(offset))).cast("long")).drop(
        "_sk_rn"
    )


def _same(keys: list[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def insert_if_absent(
    incoming: DataFrame,
    existing: DataFrame | None,
    key_cols: list[str],
    *,
    null_parts: str = "row",
    dedupe: bool = False,
) -> DataFrame:
    """Rows of ``incoming`` whose natural key is not yet in ``existing``.

    ``null_parts`` says what a NULL part of a key matches: ``row`` (default)
    only a stored row that is equal in all columns of ``incoming`` that are
    stored; ``equal`` another NULL; ``never`` nothing (the SQL
    ``NOT EXISTS (... = ...)`` guard, which inserts NULL keys again and again).
    ``dedupe=True`` additionally keeps one row per key within the batch, see
    :func:`split_duplicates`.
    """
    if null_parts not in ("row", "equal", "never"):
        raise ValueError(f"null_parts: {null_parts}")
    new = incoming
    if existing is not None:
        has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key_cols])
        ex = existing.select(*[F.col(k).alias(f"_ex_{k}") for k in key_cols])
        if null_parts == "equal":
            new = new.join(ex, _same(key_cols, "_ex_"), "left_anti")
        else:
            eq = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_ex_{k}") for k in key_cols])
            whole = new.where(~has_null).join(ex, eq, "left_anti")
            part = new.where(has_null)
            if null_parts == "row":
                cols = [c for c in incoming.columns if c in existing.columns]
                stored = existing.where(has_null).select(*[F.col(c).alias(f"_ex_{c}") for c in cols])
                part = part.join(stored, _same(cols, "_ex_"), "left_anti")
            new = whole.unionByName(part)
    return split_duplicates(new, key_cols, null_parts)[0] if dedupe else new


def split_duplicates(df: DataFrame, key_cols: list[str], null_parts: str = "row") -> tuple[DataFrame, DataFrame]:
    """(one row per key: the smallest; the rows removed, with how often each occurred).

    Rows with a NULL key part are one key only if they are equal in all columns
    (``null_parts="equal"``: if their parts are). Both results come from partial
    aggregates on the key, not from a per-key window."""
    others = [c for c in df.columns if c not in key_cols]
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key_cols])
    rest = F.struct(*others) if others else F.lit(0)
    # a NULL part makes the rest of the row part of the key
    extra = F.lit(None).cast("int") if null_parts == "equal" else F.when(has_null, F.struct(*df.columns))
    first = df.withColumn("_extra", extra).groupBy(*key_cols, "_extra").agg(F.min(rest).alias("_row"))
    kept = first.select(*key_cols, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns)
    # only worked out where the removed rows are read: all rows less the kept ones, in one aggregate
    counted = df.select(*df.columns, F.lit(1).alias("_copies")).unionAll(kept.select(*df.columns, F.lit(-1)))
    removed = counted.groupBy(*df.columns).agg(F.sum("_copies").alias("occurrences")).where("occurrences > 0")
    return kept, removed


def append_with_keys(
    incoming: DataFrame,
    existing: DataFrame | None,
    natural_key: list[str],
    key_col: str,
    *,
    null_parts: str = "row",
    dedupe: bool = False,
    order: list[str] | None = None,
) -> DataFrame:
    """Insert-if-absent followed by key assignment after the current max.

    Returns only the new rows (with keys); ``existing.unionByName(new)`` is
    the refreshed table.
    """
    new = insert_if_absent(incoming, existing, natural_key, null_parts=null_parts, dedupe=dedupe)
    return assign_surrogate_keys(new, order or natural_key, key_col, max_key(existing, key_col))
