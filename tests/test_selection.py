"""Ranks by counting against sorted lists."""

import random

import pytest
from pyspark.sql import functions as F

import carespark.operators.selection as S
from carespark.plans.features import high_cost_label


def _key(v):
    return (v != v, v)


@pytest.mark.parametrize("kind,draw", [
    ("double", lambda r: r.choice([0.0, 5.0, r.gauss(0, 1e6), r.random() * 1e-300, 1.7e308, -1.7e308, float("inf"), float("-inf"), float("nan")])),
    ("bigint", lambda r: r.choice([7, r.randrange(-2 ** 63, 2 ** 63), 2 ** 62 + r.randrange(100), r.randrange(50)])),
    ("decimal(18,2)", lambda r: round(r.choice([1.0, r.expovariate(1e-5)]), 2)),
])
def test_ranks_in_groups(spark, monkeypatch, kind, draw):
    from decimal import Decimal

    monkeypatch.setattr(S, "BINS", 8)
    monkeypatch.setattr(S, "FEW", 20)
    rng = random.Random(4)
    rows = [(rng.choice(["a", "a", "b", None]), None if rng.random() < 0.1 else draw(rng)) for _ in range(1500)] + [("one", draw(rng)), ("none", None)]
    if kind.startswith("decimal"):
        rows = [(g, None if v is None else Decimal(str(v))) for g, v in rows]
    df = spark.createDataFrame(rows, f"g string, v {kind}")
    picked, sizes = S.values_at(df, ["g"], "v", lambda n: F.array(F.lit(0), F.floor(n / 3), F.floor(n / 2), n - 1))
    groups = {g: sorted((v for k, v in rows if k == g and v is not None), key=_key) for g, _ in rows}
    want = sorted((str(g), k, repr(float(v[k]))) for g, v in groups.items() if v for k in {0, len(v) // 3, len(v) // 2, len(v) - 1})
    assert sorted((str(r.g), r["rank"], repr(float(r.v))) for r in picked.collect()) == want
    assert {r.g: r.n for r in sizes.collect()} == {g: len(v) for g, v in groups.items() if v}


@pytest.mark.parametrize("key", ["bigint", "string"])
def test_top_rows_with_ties_and_nulls(spark, monkeypatch, key):
    monkeypatch.setattr(S, "BINS", 8)
    monkeypatch.setattr(S, "FEW", 10)
    rng = random.Random(5)
    for share, values in ((0.25, [1.0, 2.0, 2.0, 3.0, None]), (0.25, [7.0]), (0.9, [None, None, 1.0]), (0.5, [None]), (0.25, [rng.random() for _ in range(99)])):
        ids = rng.sample(range(10_000), 200)
        rows = [((str(i) if key == "string" else i) if n else None, rng.choice(values)) for n, i in enumerate(ids)]
        df = spark.createDataFrame(rows, f"patient_key {key}, cost double")
        got = high_cost_label(df, cost_col="cost", fraction=share)
        order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0] is not None, r[0] if r[0] is not None else 0))
        want = {r[0] for r in order[:max(1, int(200 * share))]}
        assert {r.patient_key for r in got.where("label = 1").collect()} == want
    assert high_cost_label(df.limit(0), cost_col="cost").count() == 0


def test_plans_neither_sort_nor_store_the_rows(spark):
    df = spark.range(100_000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 1000).cast("double").alias("v"))
    picked, _ = S.values_at(df, ["g"], "v", lambda n: F.array(F.floor(n / 2)))
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "SortMergeJoin" not in plan
    assert [r.v for r in picked.orderBy("g").collect()] == [500.0, 500.0, 500.0] or picked.count() == 3
    label = high_cost_label(df.withColumn("patient_key", F.col("g")).select("patient_key", "v"), cost_col="v")
    assert "Exchange" not in label._jdf.queryExecution().executedPlan().toString()


def test_the_label_query_ranks_every_patient_of_the_features(spark):
    from carespark.plans.catalog import REGISTRY

    fn, sql = REGISTRY["high_cost_label"]
    got = fn(spark, "/root/testdata/sf0.001")
    assert got.columns == ["patient_key", "healthcare_expenses", "cost_rank", "label"] and "cost_rank" in sql.split("FROM f)")[-1]
    rows = sorted(got.collect(), key=lambda r: (-r.healthcare_expenses, r.patient_key))
    assert [r.cost_rank for r in rows] == list(range(1, len(rows) + 1))
    assert [r.label for r in rows] == [int(i < len(rows) // 4) for i in range(len(rows))]
