"""Masking and audit as table operations (GOV-01..04)."""

import datetime as dt

from pyspark.sql import functions as F

from carespark.plans import governance as GOV


def _records(spark):
    return spark.createDataFrame(
        [("abc-uuid", dt.date(1960, 3, 15), "inpatient", "Smith")],
        "patient_id string, birthdate date, encounter_class string, LAST string",
    )


def test_mask_frame(spark):
    r = GOV.mask_phi(_records(spark)).first()
    assert r.patient_id == "****aa69bb52"
    assert r.birthdate.startswith("****")  # date cast to text then masked (no leak)
    assert r.encounter_class == "inpatient"  # non-PHI untouched
    assert r.LAST.startswith("****")  # names match case-insensitively


def test_reference_mode_and_bypass(spark):
    r = GOV.mask_phi(_records(spark), strict_reference=True).first()
    assert r.birthdate == dt.date(1960, 3, 15)  # reference leaks non-string PHI
    assert GOV.mask_phi(_records(spark), phi_read=True).first().patient_id == "abc-uuid"


def test_salted_full_digest_differs(spark):
    r = GOV.mask_phi(_records(spark), salt="s3cret", full_digest=True).first()
    assert len(r.patient_id) == 4 + 64 and r.patient_id != "****aa69bb52"


def test_audit_before_read_and_disclosure(spark, tmp_path):
    path = str(tmp_path / "audit")
    req = spark.createDataFrame([("p1",), ("p2",), ("p1",), ("unknown",)], "patient_id string")
    out = GOV.audited(req, path, action="risk_score_read", accessor="api", context={"route": "risk"})
    assert out is req
    audit = spark.read.parquet(path)
    assert audit.count() == 3  # one row per distinct requested id, unknown ids included
    assert audit.where(F.col("patient_ref") == "p1").count() == 0  # ids stored hashed
    GOV.audited(req.where("patient_id = 'p1'"), path, action="care_gaps_read", accessor="api")
    d = GOV.audit_disclosure(spark.read.parquet(path), "p1")
    assert sorted(r.action for r in d.collect()) == ["care_gaps_read", "risk_score_read"]
    ctx = {r.action: r.context for r in d.collect()}
    assert ctx["risk_score_read"] == {"route": "risk"}


def test_disclosure_summary_and_tenant_scope(spark, tmp_path):
    path = str(tmp_path / "audit")
    req = spark.createDataFrame([("p1",), ("p2",)], "patient_id string")
    GOV.audited(req, path, action="a", accessor="x")
    GOV.audited(req.where("patient_id = 'p1'"), path, action="b", accessor="x")
    s = {r.actions: r.accesses for r in GOV.disclosure_summary(spark.read.parquet(path)).collect()}
    assert s == {2: 2, 1: 1}
    t = GOV.with_tenant(req, "t1").unionByName(GOV.with_tenant(req.limit(1), "t2"))
    t.write.partitionBy("tenant_id").parquet(str(tmp_path / "tenants"))
    scoped = GOV.tenant_scope(spark.read.parquet(str(tmp_path / "tenants")), "t2")
    assert scoped.count() == 1 and "tenant_id" not in scoped.columns
    assert "PartitionFilters: [isnotnull(tenant_id" in scoped._jdf.queryExecution().executedPlan().toString()


def test_chain_shows_what_was_changed_removed_or_added(spark, tmp_path):
    from datetime import date, datetime

    from pyspark.sql import functions as F

    from carespark.plans import governance as G

    rows = [(f"p{i % 40}", "read", "x", datetime(2024, 1, 1 + i % 3, 0, 0, i % 60), {"n": str(i), "a": "1"}, date(2024, 1, 1 + i % 3)) for i in range(600)]
    schema = "patient_ref string, action string, accessor string, accessed_at timestamp, context map<string,string>, access_date date"
    log = spark.createDataFrame(rows, schema)
    path = str(tmp_path / "chain")
    G.seal_days(log.repartition(3), path)
    sealed = spark.read.schema(G.CHAIN_SCHEMA).parquet(path)

    def broken(audit):
        return {(r.access_date, r.segment): r.missing for r in G.verify_chain(audit, sealed).collect() if not r.intact}

    def place(i):
        return log.where(F.col("context")["n"] == str(i)).select("access_date", F.right(F.sha2("patient_ref", 256), F.lit(2))).first()

    assert broken(log.repartition(5, "accessor")) == {}          # neither order nor layout matters
    assert broken(log.where(F.col("context")["n"] != "17")) == {tuple(place(17)): 1}
    changed = log.withColumn("accessor", F.when(F.col("context")["n"] == "18", "y").otherwise(F.col("accessor")))
    assert broken(changed) == {tuple(place(18)): 0}
    assert broken(log.unionAll(log.where(F.col("context")["n"] == "19"))) == {tuple(place(19)): -1}
    day = log.where("access_date = '2024-01-02'")
    gone = broken(log.where("access_date <> '2024-01-02'"))
    assert sum(gone.values()) == day.count() and {d for d, _ in gone} == {date(2024, 1, 2)}
    # a day is sealed again without touching the others
    G.seal_days(day.limit(5), path)
    assert spark.read.schema(G.CHAIN_SCHEMA).parquet(path).agg(F.sum("entries")).first()[0] == 405


def test_expiry_drops_whole_days_only_past_retention(spark, tmp_path):
    from carespark.plans import governance as G

    path = str(tmp_path / "audit")
    days = ["2016-06-14", "2016-06-15", "2016-06-16", "2023-06-15", "2001-01-01"]
    spark.createDataFrame([(f"p{i}", d) for d in days for i in range(3)], "patient_ref string, access_date string") \
        .write.partitionBy("access_date").parquet(path)
    assert G.expire_days(spark, path, as_of="2023-06-15") == ["2001-01-01", "2016-06-14"]
    left = spark.read.schema("patient_ref string, access_date string").parquet(path).groupBy("access_date").count().collect()
    assert sorted((r[0], r[1]) for r in left) == [(d, 3) for d in days[1:4]]
    assert G.expire_days(spark, path, as_of="2023-06-15") == []
