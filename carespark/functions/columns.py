"""Scalar Column functions.

Every function returns a native Spark ``Column`` so it stays inside
whole-stage codegen; none is a Python UDF. Casts of untrusted text are
``try_cast`` so ANSI mode can stay on (bad values become NULL).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from carespark import codes

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- casts ------------------------------------------------------------------
def try_decimal(c: ColumnOrName, precision: int = 10, scale: int = 2) -> Column:
    """SCL-01: text -> DECIMAL(p,s); extra digits round half up; junk/overflow -> NULL."""
    return _c(c).try_cast(DecimalType(precision, scale))


_PLAIN = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)$"
_SHORT = r"^[0-9]{1,9}(?:\.(?:[0-4][0-9]*)?)?$"    # a plain number that is rounded down and cannot overflow
_POWER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)[eE][+-]?[0-9]+$"


def try_integer(c: ColumnOrName) -> Column:
    """SCL-02: text -> INT with the reference's leniency.

    ``'12.7'`` -> 13, ``'-12.5'`` -> -13, ``'1e3'`` -> 1000, ``'1_000'`` -> 1000,
    ``'0x1F'`` -> 31, ``'0b11'`` -> 3; junk or overflow -> NULL. Spark's own
    try_cast to int would give NULL for all of these. A plain number is rounded
    half away from zero by its first decimal alone, so ``'12.4999999'`` is 12
    however many digits follow; a number with an exponent by 18 decimals.
    """
    text = F.trim(_c(c))
    number = F.regexp_replace(text, "(?<=[0-9])_(?=[0-9])", "")
    whole = F.regexp_extract(number, r"^[+-]?([0-9]*)", 1)
    up = F.when(F.regexp_extract(number, r"\.([0-9])", 1) >= "5", 1).otherwise(0)
    size = F.when(whole == "", F.lit(0).cast("decimal(38,0)")).otherwise(whole.try_cast(DecimalType(38, 0))) + up
    plain = F.when(number.startswith("-"), -size).otherwise(size).try_cast("int")
    power = F.coalesce(
        F.round(number.try_cast(DecimalType(38, 18)), 0).try_cast("int"),
        F.round(number.try_cast("double"), 0).try_cast("int"),
    )
    digits = F.regexp_replace(text, "(?<=[0-9a-fA-F])_(?=[0-9a-fA-F])", "")
    return (
        F.when(text.rlike(_SHORT), F.substring_index(text, ".", 1).try_cast("int"))     # most values: no further pattern is tried
        .when(number.rlike(_PLAIN), plain)
        .when(number.rlike(_POWER), power)
        .when(digits.rlike("^0[xX][0-9a-fA-F]{1,16}$"), F.conv(F.substring(digits, 3, 16), 16, 10).try_cast("int"))
        .when(digits.rlike("^0[bB][01]{1,64}$"), F.conv(F.substring(digits, 3, 64), 2, 10).try_cast("int"))
    )


_ISO_SHAPE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
_DATE_SHAPE = r"^[0-9]{4}([-/ \\])[0-9]{1,2}\1[0-9]{1,2}$"


def iso_prefix_to_date(c: ColumnOrName) -> Column:
    """SCL-03/18: first 10 characters of an ISO date or datetime -> DATE.

    A shape guard rejects ``'2022'`` and ``'2022-01'`` (which Spark alone
    would widen to the first day of the year/month) and mixed separators
    (``'2022-01/05'``); both separators may be ``/``, a blank or a backslash
    instead; impossible dates such as ``2022-02-30`` become NULL.
    """
    head = F.rtrim(F.substring(_c(c), 1, 10))
    return F.when(head.rlike(_ISO_SHAPE), head.try_cast("date")).when(head.rlike(_DATE_SHAPE), F.translate(head, "/ \\", "---").try_cast("date"))


def yyyymmdd_to_date(c: ColumnOrName) -> Column:
    """SCL-25: legacy ``YYYYMMDD`` text -> DATE (NULL when malformed)."""
    s = F.trim(_c(c))
    iso = F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2))
    return F.when(s.rlike(r"^[0-9]{8}$"), iso.try_cast("date"))


def date_key(d: ColumnOrName) -> Column:
    """SCL-04: DATE -> YYYYMMDD integer (NULL stays NULL, no string formatting)."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_from_key(k: ColumnOrName) -> Column:
    """Inverse of :func:`date_key` (NULL for non-dates)."""
    k = _c(k)
    return F.try_make_date(
        (k / 10000).cast("int"), ((k / 100) % 100).cast("int"), (k % 100).cast("int")
    ) if hasattr(F, "try_make_date") else F.make_date(
        (k / 10000).cast("int"), ((k / 100) % 100).cast("int"), (k % 100).cast("int")
    )


def blank_to_null(c: ColumnOrName) -> Column:
    """SCL-05: empty string -> NULL."""
    return F.nullif(_c(c), F.lit(""))


def optional_date(c: ColumnOrName) -> Column:
    """SCL-06: optional stop date; blank -> NULL (still active), else parsed."""
    return iso_prefix_to_date(blank_to_null(c))


# -- date parts --------------------------------------------------------------
def day_of_week_sun0(d: ColumnOrName) -> Column:
    """SCL-08: 0=Sunday ... 6=Saturday (Spark's dayofweek is 1=Sunday)."""
    return (F.dayofweek(_c(d)) - 1).cast("short")


def date_parts(d: ColumnOrName, prefix: str = "") -> list[Column]:
    """SCL-07/08: year, month, day, quarter, day_of_week as SMALLINT columns."""
    d = _c(d)
    return [
        F.year(d).cast("short").alias(f"{prefix}year"),
        F.month(d).cast("short").alias(f"{prefix}month"),
        F.dayofmonth(d).cast("short").alias(f"{prefix}day"),
        F.quarter(d).cast("short").alias(f"{prefix}quarter"),
        day_of_week_sun0(d).alias(f"{prefix}day_of_week"),
    ]


def days_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """SCL-09: whole days ``later - earlier`` (negative allowed)."""
    return F.datediff(_c(later), _c(earlier))


def year_boundary_age(as_of: ColumnOrName, birth: ColumnOrName) -> Column:
    """SCL-10: age as count of calendar-year boundaries (not completed years)."""
    return F.year(_c(as_of)) - F.year(_c(birth))


def as_of_date(as_of: str | None) -> Column:
    """SCL-11: explicit as-of date, default today's date."""
    return F.to_date(F.lit(as_of)) if as_of else F.current_date()


# -- numbers ----------------------------------------------------------------
def safe_pct(num: ColumnOrName, den: ColumnOrName, digits: int = 2) -> Column:
    """SCL-16: round(100 * num / den, 2) as DOUBLE, NULL when den is 0 or NULL."""
    return round_double(
        F.lit(100.0) * _c(num).cast("double") / F.nullif(_c(den), F.lit(0)).cast("double"),
        digits,
    )


def round_double(c: ColumnOrName, digits: int = 2) -> Column:
    """SCL-15 on DOUBLE: scale, round half away from zero, unscale (trap T6).

    This is the reference engine's method: ``round(1.005, 2)`` gives 1.0
    and ``237778.855`` computed as a double quotient gives .86, whereas
    Spark's ``round`` works on the shortest decimal text of the double.
    """
    m = float(10 ** digits)
    return F.round(_c(c).cast("double") * F.lit(m), 0) / F.lit(m)


def round2(c: ColumnOrName) -> Column:
    """SCL-15: 2-digit rounding as DOUBLE (decimals round exactly, then cast)."""
    return round_double(c, 2)


def to_double(c: ColumnOrName) -> Column:
    """SCL-20: decimal -> double."""
    return _c(c).cast("double")


# -- masking ----------------------------------------------------------------
def mask_value(c: ColumnOrName, salt: str | None = None, full_digest: bool = False) -> Column:
    """SCL-19 / GOV-01: ``'****' + first 8 hex of SHA-256``; NULL stays NULL.

    ``salt``/``full_digest`` harden the default (32-bit, unsalted) mask.
    """
    v = _c(c).cast("string")
    if salt:
        v = F.concat(F.lit(salt), v)
    digest = F.sha2(v, 256)
    if not full_digest:
        digest = F.substring(digest, 1, codes.MASK_HEX_CHARS)
    return F.when(_c(c).isNotNull(), F.concat(F.lit(codes.MASK_PREFIX), digest))


# -- legacy code decoding (SCL-26) ---------------------------------------
def decode_yes_no_12(c: ColumnOrName) -> Column:
    """``'1'`` -> true, ``'2'`` -> false, anything else -> NULL."""
    s = F.trim(_c(c))
    return F.when(s == "1", F.lit(True)).when(s == "2", F.lit(False))


def decode_yn(c: ColumnOrName) -> Column:
    """``'Y'`` -> true, ``'N'`` -> false (case-insensitive), else NULL."""
    s = F.upper(F.trim(_c(c)))
    return F.when(s == "Y", F.lit(True)).when(s == "N", F.lit(False))


def decode_sex(c: ColumnOrName) -> Column:
    """Legacy sex code ``'1'`` -> ``'M'``, ``'2'`` -> ``'F'``, else NULL."""
    s = F.trim(_c(c))
    return F.when(s == "1", F.lit("M")).when(s == "2", F.lit("F"))


def year_from_file_name(c: ColumnOrName) -> Column:
    """SCL-27: first 4-digit year (19xx/20xx) in a file name, as INT."""
    y = F.regexp_extract(_c(c), r"((?:19|20)[0-9]{2})", 1)
    return F.nullif(y, F.lit("")).try_cast("int")
