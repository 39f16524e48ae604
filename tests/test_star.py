"""Star schema build: counts, keys, idempotency, null-safe guards, quarantine."""

from pyspark.sql import functions as F

from carespark.plans.star import build_star
from carespark.sources.csv_ingest import load_raw
from tests.conftest import BASE, PID1, write_fixture


def test_calendar_and_one_row_per_table(base_star):
    _, b = base_star
    assert b.tables["dim_date"].count() == 11323
    for t in ["dim_patient", "dim_provider", "dim_condition_code", "fact_encounter",
              "fact_condition", "fact_medication"]:
        assert b.tables[t].count() == 1, t


def test_key_lookups_and_types(base_star):
    _, b = base_star
    fe = b.tables["fact_encounter"].first()
    dp = b.tables["dim_patient"].first()
    assert fe.patient_key == dp.patient_key == 1
    assert fe.start_date_key == 20220110 and fe.stop_date_key == 20220112
    assert str(fe.total_claim_cost) == "7500.00" and fe.reason_code is None
    fc = b.tables["fact_condition"].first()
    assert fc.stop_date_key is None and fc.encounter_key == fe.encounter_key
    fm = b.tables["fact_medication"].first()
    assert fm.dispenses == 3 and str(fm.total_cost) == "15.00"
    assert dp.income == 55000 and str(dp.zip) == "01101"


def test_rebuild_is_idempotent_with_orphans_and_blank_codes(spark, tmp_path):
    spec = dict(BASE)
    spec["conditions.csv"] = BASE["conditions.csv"] + [
        {"START": "2019-01-01", "STOP": "", "PATIENT": "ghost", "ENCOUNTER": "", "CODE": "1",
         "DESCRIPTION": "orphan"},
        {**BASE["conditions.csv"][0]},  # identical row twice in one file
    ]
    spec["medications.csv"] = BASE["medications.csv"] + [
        {**BASE["medications.csv"][0], "CODE": "", "START": "2022-02-01"},
    ]
    d = write_fixture(tmp_path / "in", spec)
    res = load_raw(spark, d, str(tmp_path / "raw"))
    first = build_star(spark, res.tables)
    tables = {k: v for k, v in first.tables.items()}
    fc = tables["fact_condition"]
    assert fc.count() == 3  # the identical row stays: nothing is lost unless asked for
    assert fc.where(F.col("patient_key").isNull()).count() == 1  # orphan kept, NULL key
    assert tables["fact_medication"].where(F.col("rxnorm_code").isNull()).count() == 1
    from carespark.operators.quality import orphan_report

    rep = {(r.table_name, r.key_column): r.orphan_rows for r in orphan_report(tables).collect()}
    assert rep[("fact_condition", "patient_key")] == 1 and rep[("fact_encounter", "patient_key")] == 0
    # persist the first build, then build again from the same raw files
    out = {}
    for k, v in tables.items():
        p = str(tmp_path / "star" / k)
        v.write.parquet(p)
        out[k] = spark.read.parquet(p)
    second = build_star(spark, res.tables, existing=out)
    for k in ["dim_patient", "dim_provider", "fact_encounter", "fact_condition", "fact_medication"]:
        assert second.appended[k].count() == 0, k


def test_reference_guard_reinserts_null_keys(spark):
    from carespark.operators.keys import insert_if_absent

    existing = spark.createDataFrame([(None, "1", "x"), (5, "1", "y")], "patient_key long, code string, d string")
    args = (existing, existing, ["patient_key", "code"])
    # SQL '=' never matches NULL: the orphan is inserted again (reference defect 3)
    assert insert_if_absent(*args, null_parts="never").count() == 1
    assert insert_if_absent(*args).count() == 0 and insert_if_absent(*args, null_parts="equal").count() == 0


def test_orphans_of_different_patients_stay_apart(spark, tmp_path):
    ghost = {"START": "2019-01-01", "STOP": "", "ENCOUNTER": "", "CODE": "1", "DESCRIPTION": "orphan"}
    spec = dict(BASE)
    spec["conditions.csv"] = BASE["conditions.csv"] + [{**ghost, "PATIENT": "ghost1"}, {**ghost, "PATIENT": "ghost2"}]
    res = load_raw(spark, write_fixture(tmp_path / "in", spec), str(tmp_path / "raw"))
    first = build_star(spark, res.tables, targets=["fact_condition"])
    stored = {}
    for k, v in first.tables.items():
        v.write.parquet(str(tmp_path / "star" / k))
        stored[k] = spark.read.parquet(str(tmp_path / "star" / k))
    fc = stored["fact_condition"]
    assert sorted(r.patient_id for r in fc.where("patient_key is null").collect()) == ["ghost1", "ghost2"]
    # a later batch with a third unknown patient, same code and day, and a first one again
    spec["conditions.csv"] = [{**ghost, "PATIENT": "ghost3"}, {**ghost, "PATIENT": "ghost1"}]
    more = load_raw(spark, write_fixture(tmp_path / "in2", spec), str(tmp_path / "raw2"))
    b = build_star(spark, more.tables, existing=stored, targets=["fact_condition"])
    assert [r.patient_id for r in b.appended["fact_condition"].collect()] == ["ghost3"]


def test_duplicates_are_counted_when_removed(spark):
    from carespark.operators.keys import insert_if_absent, split_duplicates

    df = spark.createDataFrame([(1, "a", 5.0), (1, "a", 7.0), (1, "a", 7.0), (None, "a", 1.0), (None, "a", 2.0), (None, "a", 2.0), (2, "b", 1.0)],
                               "k long, code string, cost double")
    kept, gone = split_duplicates(df, ["k", "code"])
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, "a", 5.0), (None, "a", 1.0), (None, "a", 2.0), (2, "b", 1.0)], key=str)
    assert sorted(map(tuple, gone.collect()), key=str) == sorted([(1, "a", 7.0, 2), (None, "a", 2.0, 1)], key=str)
    assert insert_if_absent(df, None, ["k", "code"]).count() == 7


def test_long_keys_are_not_cut(spark):
    from carespark.sources.driver_raw import _natural_id, _sql_id

    import duckdb

    keys = [7, 999999999, 1234567890, 12345678901]
    got = [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k long").select(_natural_id("C#", F.col("k"))).collect()]
    want = duckdb.sql("SELECT " + _sql_id("C#", "k") + f" FROM (SELECT unnest({keys}) AS k)").fetchall()
    assert got == [w[0] for w in want] and len(set(got)) == 4 and got[0] == "C#000000007"


def test_out_of_calendar_encounter_is_quarantined(spark, tmp_path):
    spec = dict(BASE)
    spec["encounters.csv"] = BASE["encounters.csv"] + [
        {**BASE["encounters.csv"][0], "Id": "old", "START": "1995-03-01T00:00:00Z",
         "STOP": "1995-03-02T00:00:00Z"},
    ]
    d = write_fixture(tmp_path / "in", spec)
    res = load_raw(spark, d, str(tmp_path / "raw"))
    b = build_star(spark, res.tables, targets=["fact_encounter"])
    assert b.tables["fact_encounter"].count() == 1
    assert [r.encounter_id for r in b.quarantined["fact_encounter"].collect()] == ["old"]


def test_code_dictionary_one_description_per_code(spark, tmp_path):
    spec = dict(BASE)
    spec["conditions.csv"] = BASE["conditions.csv"] + [
        {**BASE["conditions.csv"][0], "START": "2019-01-01", "DESCRIPTION": "Type 2 diabetes"},
        {**BASE["conditions.csv"][0], "CODE": "", "START": "2019-02-01"},
    ]
    d = write_fixture(tmp_path / "in", spec)
    res = load_raw(spark, d, str(tmp_path / "raw"))
    b = build_star(spark, res.tables, targets=["dim_condition_code"])
    rows = b.tables["dim_condition_code"].collect()
    assert len(rows) == 1 and rows[0].snomed_code == "44054006"


def test_surrogate_keys_dense_and_after_max(spark):
    from carespark.operators.keys import append_with_keys

    existing = spark.createDataFrame([("a", 1), ("c", 7)], "nk string, k long")
    incoming = spark.createDataFrame([("b",), ("c",), ("d",), ("a",)], "nk string")
    new = append_with_keys(incoming, existing, ["nk"], "k")
    assert sorted((r.nk, r.k) for r in new.collect()) == [("b", 8), ("d", 9)]


def test_constraints_of_the_star(spark, tmp_path):
    from carespark.plans.star import check_star

    spec = dict(BASE)
    spec["patients.csv"] = BASE["patients.csv"] + [{**BASE["patients.csv"][0], "ID": ""}, {**BASE["patients.csv"][0]}]
    res = load_raw(spark, write_fixture(tmp_path / "in", spec), str(tmp_path / "raw"))
    b = build_star(spark, res.tables, targets=["fact_encounter", "dim_condition_code"])
    checks = check_star(b.tables).collect()
    assert len(checks) >= 16 and all(r.violations == 0 for r in checks)
    # the row without an id is kept apart, the repeated patient counted
    assert b.rejected["dim_patient"].count() == 1 and b.rejected["dim_patient"].first().null_column == "patient_id"
    assert b.duplicates["dim_patient"].first().occurrences == 1
    broken = {"dim_patient": b.tables["dim_patient"].unionAll(b.tables["dim_patient"])}
    assert {(r.key_column, r.rule) for r in check_star(broken).where("violations > 0").collect()} == {
        ("patient_key", "unique"), ("patient_id", "unique")}


def test_partitions_are_few_files(spark, tmp_path):
    import os

    from carespark.plans.marts import write_mart

    path = str(tmp_path / "mart")
    write_mart(spark.range(0, 2000, 1, 16).withColumn("y", F.col("id") % 5), path, ["y"], mode="full")
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) <= 10 and spark.read.parquet(path).count() == 2000


def test_calendar_is_measured_before_a_broadcast(spark, monkeypatch):
    from carespark.operators import calendar as CAL

    cal = CAL.calendar_dim(spark, ("2000-01-01", "2000-12-31"))
    fact = spark.createDataFrame([(20000105,)], "k int")
    plan = lambda: CAL.join_calendar(fact, cal, "k", "s_")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan()
    monkeypatch.setattr(CAL, "MAX_BROADCAST_CALENDAR_DAYS", 100)
    assert "strategy=broadcast" not in plan()
    days = spark.createDataFrame([("2001-03-04", "2001-05-06")], "a string, b string").select(F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    assert CAL.date_range(days, "a", "b") == ("2001-03-04", "2001-05-06")


def test_quality_checks(spark):
    from carespark.operators.quality import check_fk, check_not_null, check_unique, enforce

    fact = spark.createDataFrame([(1, 10), (2, 11), (3, None), (3, 12)], "id int, fk int")
    dim = spark.createDataFrame([(10,), (12,)], "k int")
    assert [r.id for r in check_fk(fact, "fk", dim, "k").collect()] == [2]
    assert check_unique(fact, ["id"]).first().occurrences == 2
    assert check_not_null(fact, ["fk"]).first().null_column == "fk"
    good, bad = enforce(fact, check_fk(fact, "fk", dim, "k"), ["id"])
    assert good.count() == 3 and bad.count() == 1


def test_patient_lookup_is_a_filter(base_star, spark):
    from carespark.plans.features import patient_features
    from carespark.plans.star import mart_inputs
    from carespark import codes

    _, b = base_star
    mi = mart_inputs(b.tables)
    f = patient_features(mi["patients"], mi["encounters"], mi["conditions"],
                         condition_sets=codes.CLINICAL_CONDITION_SETS, as_of="2024-01-01")
    assert f.where(F.col("patient_id") == PID1).count() == 1
    assert f.where(F.col("patient_id") == "unknown").count() == 0


def test_bucketed_star_needs_no_shuffle_for_patient_features(spark, golden_star, tmp_path):
    from carespark import codes
    from carespark.plans.features import patient_features
    from carespark.plans.marts import persist_star
    from carespark.plans.star import mart_inputs

    tabs = persist_star(golden_star[1].tables, "carestar_test", str(tmp_path / "wh"), buckets=4)
    mi = mart_inputs(tabs)
    f = patient_features(mi["patients"], mi["encounters"], mi["conditions"],
                         condition_sets=codes.CLINICAL_CONDITION_SETS, as_of="2024-01-01")
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert f.count() == 3
    # year partitioning prunes a year filter to one folder
    one_year = tabs["fact_encounter"].where("start_year = 2021")
    assert "PartitionFilters: [isnotnull(start_year" in one_year._jdf.queryExecution().executedPlan().toString()
    assert one_year.count() == 1


def test_a_fact_is_parsed_and_joined_once(spark, tmp_path, monkeypatch):
    """The sampling of the range partitions and the de-duplication read a written stage, not the parse."""
    from carespark.plans import star
    from carespark.sources.driver import DriverTables
    from carespark.sources.driver_raw import raw_tables

    given = []
    keyed = star.assign_surrogate_keys
    monkeypatch.setattr(star, "assign_surrogate_keys", lambda df, *a, **k: given.append(df) or keyed(df, *a, **k))
    t = DriverTables(spark, "/root/testdata/sf0.001")
    star.build_star(spark, raw_tables(t), calendar=t.calendar, targets=["fact_medication"])
    plan = given[-1]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "cast(" not in plan


def test_removed_rows_beside_nulls(spark):
    from carespark.operators.keys import split_duplicates

    rows = [("a", None, 1), ("a", None, 1), ("b", 1, None), ("b", 1, None), ("b", 1, 2), (None, 1, 1), (None, 1, 1), (None, 1, 2)]
    df = spark.createDataFrame(rows, "k string, code int, v int")
    kept, gone = split_duplicates(df, ["k", "code"])
    assert kept.count() == 4
    assert {tuple(r) for r in gone.collect()} == {("a", None, 1, 1), ("b", 1, None, 1), ("b", 1, 2, 1), (None, 1, 1, 1)}
    plan = gone._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
