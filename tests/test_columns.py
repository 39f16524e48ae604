"""Scalar functions including the semantic traps of §8."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from carespark.functions import columns as C
from carespark.plans.caregaps import narrative_summary


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [
    ("abc", None), ("12.345", "12.35"), ("123456789.12", None), ("", None), ("-0.005", "-0.01"),
])
def test_try_decimal(spark, text, expected):
    r = one(spark, C.try_decimal("s", 10, 2), text)
    assert (str(r) if r is not None else None) == expected


@pytest.mark.parametrize("text,expected", [
    ("12.7", 13), ("-12.5", -13), ("1e3", 1000), ("3", 3), ("x", None), ("2147483648", None),
])
def test_try_integer_reference_leniency(spark, text, expected):
    assert one(spark, C.try_integer("s"), text) == expected


@pytest.mark.parametrize("text,expected", [
    ("2022-1-5", dt.date(2022, 1, 5)), ("2022-02-30", None), ("2022", None), ("2022-01", None),
    ("", None), ("2022-01-10T09:00:00Z", dt.date(2022, 1, 10)), ("20220105", None),
])
def test_iso_prefix_to_date(spark, text, expected):
    assert one(spark, C.iso_prefix_to_date("s"), text) == expected


def test_yyyymmdd(spark):
    assert one(spark, C.yyyymmdd_to_date("s"), "20220105") == dt.date(2022, 1, 5)
    assert one(spark, C.yyyymmdd_to_date("s"), "20220230") is None


def test_date_key_and_dow(spark):
    d = spark.createDataFrame([(dt.date(2024, 1, 7),)], "d date")  # a Sunday
    r = d.select(C.date_key("d").alias("k"), C.day_of_week_sun0("d").alias("w")).first()
    assert r.k == 20240107 and r.w == 0


def test_year_boundary_age_is_not_completed_years(spark):
    d = spark.createDataFrame([(dt.date(1960, 3, 15),)], "d date")
    assert d.select(C.year_boundary_age(F.to_date(F.lit("2024-01-01")), "d")).first()[0] == 64


def test_mask_value_reference_digest(spark):
    assert one(spark, C.mask_value("s"), "abc-uuid") == "****aa69bb52"
    assert one(spark, C.mask_value("s"), None) is None


def test_safe_pct_and_round(spark):
    df = spark.createDataFrame([(1, 0), (1, 3), (1, 8)], "a int, b int")
    r = [x[0] for x in df.select(C.safe_pct("a", "b")).collect()]
    assert r == [None, 33.33, 12.5]
    # T6: the reference engine rounds 1.005 (binary just below) down
    assert one(spark, C.round_double(F.col("x")), 1.005, "x double") == 1.0


@pytest.mark.parametrize("gaps,expected", [
    ([], "No open care gaps identified for this patient."),
    (["A"], "Patient has 1 open care gap(s): A. Clinical review recommended."),
    (["A", "B", "C"], "Patient has 3 open care gap(s): A, B, C. Clinical review recommended."),
    (["A", "B", "C", "D"],
     "Patient has 4 open care gap(s): A, B, C (and 1 more). Clinical review recommended."),
])
def test_narrative(spark, gaps, expected):
    df = spark.createDataFrame([(gaps,)], "g array<string>")
    assert df.select(narrative_summary(F.slice("g", 1, 3), F.size("g"))).first()[0] == expected


def test_no_python_udf_in_scalar_plans(spark):
    df = spark.createDataFrame([("12.7",)], "s string").select(
        C.try_integer("s"), C.iso_prefix_to_date("s"), C.mask_value("s")
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
