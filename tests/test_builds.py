"""Comparing stored builds by their folders' sums."""

import random

import pytest

from carespark.plans import builds as B
from carespark.plans.marts import diff_results

SCHEMA = "key long, value double, note string, year int"


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("change", ["none", "value", "lost", "repeated", "null year", "new year"])
def test_only_differing_folders_are_read(spark, tmp_path, change):
    rng = random.Random(2)
    a = [(i, rng.choice([1.5, None, -0.25]), rng.choice(["x", None, ""]), rng.choice([2020, 2021, None])) for i in range(300)]
    a += a[:20]                                  # repeated rows
    b = list(a)
    if change == "value":
        b[50] = (b[50][0], 9.0, *b[50][2:])
    elif change == "lost":
        b = b[:-1]                               # one of two equal rows
    elif change == "repeated":
        b.append(b[7])
    elif change == "null year":
        b.append((1000, 1.0, "n", None))
    elif change == "new year":
        b += [(5, 1.0, "n", 2030), (6, None, None, 2030)]
    rng.shuffle(b)
    fa, fb = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)
    for df, name in ((fa.repartition(3), "a"), (fb, "b")):
        B.store_build(df, str(tmp_path / name), "year", ["key"], buckets=4)
    found = B.differing_folders(spark, str(tmp_path / "a"), str(tmp_path / "b"), "year")
    assert len(found) <= 2 and bool(found) == (change != "none")
    got = B.diff_builds(spark, str(tmp_path / "a"), str(tmp_path / "b"), fa, "year")
    assert rows(got) == rows(diff_results(fa, fb))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert change == "none" or "PartitionFilters" in plan and "_bucket" in plan.split("PartitionFilters", 1)[1][:300]
