"""Registered queries: legacy lineage, mart refresh/export/diff, load report,
records export, audit and the risk model."""

from __future__ import annotations

from pyspark.sql import functions as F

from carespark import codes
from carespark.plans import analytics as A
from carespark.plans import features as FE
from carespark.plans import governance as GOV
from carespark.plans import legacy as L
from carespark.plans import builds as B
from carespark.plans import marts as M
from carespark.plans import risk as R
from carespark.functions.columns import mask_value
from carespark.plans import caregaps as G
from carespark.plans.catalog import REGISTRY, T, _FLAGS_SQL, _in_cal, register
from carespark.sources.driver import sql_with


@register(
    "cohort_rollup",
    sql_with(["encounter_base", "condition"], f"""WITH pc AS ({_FLAGS_SQL}),
py AS (SELECT e.patient_key, CAST(year(MIN(e.start_date)) AS INTEGER) AS first_encounter_year
       FROM encounter_base e WHERE {_in_cal('e.start_date')} GROUP BY e.patient_key),
pa AS (SELECT py.first_encounter_year, CASE WHEN c.c_mktsegment = 'MACHINERY' THEN 'M' ELSE 'F' END AS gender,
         COALESCE(pc.has_diabetes, 0) AS has_diabetes, COALESCE(pc.has_heart_failure, 0) AS has_heart_failure,
         COALESCE(pc.condition_count, 0) AS condition_count
       FROM py JOIN customer c ON c.c_custkey = py.patient_key LEFT JOIN pc ON pc.patient_key = py.patient_key)
SELECT first_encounter_year, gender, CAST(GROUPING(first_encounter_year, gender) AS BIGINT) AS grouping_id,
  COUNT(*) AS patients, CAST(SUM(has_diabetes) AS BIGINT) AS has_diabetes_patients,
  CAST(SUM(has_heart_failure) AS BIGINT) AS has_heart_failure_patients,
  CAST(SUM(CASE WHEN condition_count >= 2 THEN 1 ELSE 0 END) AS BIGINT) AS comorbid_patients
FROM pa GROUP BY ROLLUP (first_encounter_year, gender)"""),
)
def q_cohort_rollup(spark, sf_dir):
    t = T(spark, sf_dir)
    py = A.first_encounter_year(t.encounters(), t.calendar)
    pc = A.patient_condition_flags(t.conditions(), t.condition_sets)
    pa = py.join(t.patients().select("patient_key", "gender"), "patient_key").join(pc, "patient_key", "left")
    pa = pa.select(
        "first_encounter_year", "gender",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("has_diabetes", "has_heart_failure", "condition_count")],
    )
    r = L.cohort_rollup(pa, ["first_encounter_year", "gender"], ["has_diabetes", "has_heart_failure"], "condition_count")
    return r.withColumn("grouping_id", F.col("grouping_id").cast("long"))


@register(
    "provider_rank",
    sql_with(["encounter"], """WITH pt AS (SELECT provider_key, COUNT(*) AS encounters, SUM(total_claim_cost) AS total_cost
  FROM encounter WHERE provider_key IS NOT NULL GROUP BY provider_key)
SELECT provider_key, encounters, CAST(total_cost AS DOUBLE) AS total_cost,
  RANK() OVER (ORDER BY total_cost DESC) AS rank FROM pt"""),
)
def q_provider_rank(spark, sf_dir):
    e = T(spark, sf_dir).encounters_with_stop().where(F.col("provider_key").isNotNull())
    pt = e.groupBy("provider_key").agg(
        F.count(F.lit(1)).alias("encounters"), F.sum("total_claim_cost").alias("total_cost")
    )
    r = L.rank_desc(pt, "total_cost", "provider_key")
    return r.select("provider_key", "encounters", F.col("total_cost").cast("double").alias("total_cost"), "rank")


@register(
    "next_year_high_cost",
    sql_with(["encounter_base"], """WITH py AS (SELECT patient_key, CAST(year(start_date) AS INTEGER) AS year,
    SUM(total_claim_cost) AS year_cost FROM encounter_base GROUP BY 1, 2),
cut AS (SELECT year, PERCENTILE_CONT(0.75) WITHIN GROUP (ORDER BY CAST(year_cost AS DOUBLE)) AS cut FROM py GROUP BY year)
SELECT a.patient_key, a.year, CAST(a.year_cost AS DOUBLE) AS year_cost, CAST(b.year_cost AS DOUBLE) AS next_year_cost,
  CASE WHEN b.year_cost IS NOT NULL AND CAST(b.year_cost AS DOUBLE) >= c.cut THEN 1 ELSE 0 END AS next_year_high_cost
FROM py a LEFT JOIN py b ON b.patient_key = a.patient_key AND b.year = a.year + 1
LEFT JOIN cut c ON c.year = a.year + 1"""),
)
def q_next_year_high_cost(spark, sf_dir):
    return L.next_year_high_cost(T(spark, sf_dir).encounters())


@register(
    "patient_year_scd",
    sql_with(["encounter_base"], """SELECT patient_key, CAST(year(start_date) AS INTEGER) AS year, COUNT(*) AS rows_in_year,
  arg_max(encounter_class, strftime(start_date, '%Y%m%d') || lpad(CAST(encounter_key AS VARCHAR), 20, '0')) AS latest_encounter_class,
  CAST(arg_max(total_claim_cost, strftime(start_date, '%Y%m%d') || lpad(CAST(encounter_key AS VARCHAR), 20, '0')) AS DOUBLE) AS latest_total_claim_cost
FROM encounter_base GROUP BY 1, 2"""),
)
def q_patient_year_scd(spark, sf_dir):
    s = L.patient_year_scd(T(spark, sf_dir).encounters(), value_cols=["encounter_class", "total_claim_cost"])
    return s.withColumn("latest_total_claim_cost", F.col("latest_total_claim_cost").cast("double"))


@register(
    "claim_line_union",
    sql_with(["encounter_base", "medication"], """WITH u AS (
  SELECT 'encounter' AS claim_type, start_date, total_claim_cost AS cost FROM encounter_base
  UNION ALL SELECT 'medication', start_date, total_cost FROM medication)
SELECT claim_type, CAST(year(start_date) AS INTEGER) AS year, COUNT(*) AS claims, CAST(SUM(cost) AS DOUBLE) AS total_cost
FROM u GROUP BY 1, 2"""),
)
def q_claim_line_union(spark, sf_dir):
    t = T(spark, sf_dir)
    u = L.claim_line_union({
        "encounter": t.encounters().select("start_date", F.col("total_claim_cost").alias("cost")),
        "medication": t.medications().select("start_date", F.col("total_cost").alias("cost")),
    })
    return u.groupBy("claim_type", F.year("start_date").alias("year")).agg(
        F.count(F.lit(1)).alias("claims"), F.sum("cost").cast("double").alias("total_cost")
    )


@register(
    "unpivot_wide",
    """SELECT p_partkey, slot, code FROM (
  SELECT p_partkey, 'p_brand' AS slot, p_brand AS code FROM part
  UNION ALL SELECT p_partkey, 'p_type', p_type FROM part
  UNION ALL SELECT p_partkey, 'p_name', p_name FROM part) WHERE code IS NOT NULL AND trim(code) <> ''""",
)
def q_unpivot_wide(spark, sf_dir):
    p = T(spark, sf_dir).raw("part")
    return L.unpivot_wide(p, ["p_partkey"], ["p_brand", "p_type", "p_name"])


_UTIL_BASE_SQL = f"""SELECT CAST(year(start_date) AS INTEGER) AS encounter_year, encounter_class,
  COUNT(*) AS encounter_count, CAST(ROUND(SUM(total_claim_cost), 2) AS DOUBLE) AS total_cost
FROM encounter_base WHERE {_in_cal('start_date')} GROUP BY 1, 2"""


@register("mart_utilization_summary", sql_with(["encounter_base"], _UTIL_BASE_SQL))
def q_mart_utilization_summary(spark, sf_dir):
    """MRT-10/P15: a mart whose latest year is stale, a refresh of that year only
    (dynamic partition overwrite), then read the mart back."""
    t = T(spark, sf_dir)
    base = A.utilization_base(t.encounters(), calendar=t.calendar).withColumn(
        "total_cost", F.col("total_cost").cast("double")
    )
    path = M.work_dir(spark, "mart-utilization")
    latest = t.encounters().agg(F.max(F.year("start_date"))).first()[0]
    # the mart as it was before the latest year was complete: one class only, other counts
    old = base.where((F.col("encounter_year") < latest) | (F.col("encounter_class") == "1-URGENT"))
    M.write_mart(old.withColumn("encounter_count", F.when(F.col("encounter_year") == latest, 0).otherwise(F.col("encounter_count"))),
                 path, ["encounter_year"], mode="full")
    M.write_mart(base.where(F.col("encounter_year") == latest), path, ["encounter_year"], mode="dynamic")
    return spark.read.parquet(path).select("encounter_year", "encounter_class", "encounter_count", "total_cost")


SCAN_YEAR = 1998


@register(
    "partitioned_scan_year",
    sql_with(["encounter_base"], f"""SELECT encounter_key, patient_key, encounter_class,
  CAST(total_claim_cost AS DOUBLE) AS total_claim_cost, CAST(year(start_date) AS INTEGER) AS encounter_year
FROM encounter_base WHERE year(start_date) = {SCAN_YEAR}"""),
)
def q_partitioned_scan_year(spark, sf_dir):
    """SRC-15/P12: export partitioned by year, then a pruned read of one year."""
    e = T(spark, sf_dir).encounters().select(
        "encounter_key", "patient_key", "encounter_class",
        F.col("total_claim_cost").cast("double").alias("total_claim_cost"),
        F.year("start_date").alias("encounter_year"),
    )
    path = M.work_dir(spark, "export-encounters")
    M.export_partitioned(e, path, "encounter_year")
    return spark.read.parquet(path).where(F.col("encounter_year") == SCAN_YEAR)


REF_CAL = codes.REFERENCE_CALENDAR


@register(
    "result_diff_exceptall",
    sql_with(["encounter_base"], f"""WITH a AS ({_UTIL_BASE_SQL}),
b AS ({_UTIL_BASE_SQL.replace(_in_cal('start_date'), f"start_date BETWEEN DATE '{REF_CAL[0]}' AND DATE '{REF_CAL[1]}'")})
SELECT *, 'only_in_a' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL SELECT *, 'only_in_b' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)"""),
)
def q_result_diff_exceptall(spark, sf_dir):
    """SRC-16: diff of two builds — the driver calendar vs the reference
    calendar (2000..2030), which drops the earlier years."""
    t = T(spark, sf_dir)
    a = A.utilization_base(t.encounters(), calendar=t.calendar)
    b = A.utilization_base(t.encounters(), calendar=REF_CAL)
    cast = lambda d: d.withColumn("total_cost", F.col("total_cost").cast("double"))
    return M.diff_results(cast(a), cast(b))


_CHANGED, _LOST = "o_orderkey % 9973 = 5", "o_orderkey % 9967 = 7"


@register("result_diff_buckets", f"""WITH a AS (SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DOUBLE) AS cost, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders),
b AS (SELECT o_orderkey, o_custkey, cost + CASE WHEN {_CHANGED} THEN 1 ELSE 0 END AS cost, order_year FROM a WHERE NOT ({_LOST}))
SELECT *, 'only_in_a' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL SELECT *, 'only_in_b' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def q_result_diff_buckets(spark, sf_dir):
    """SRC-16: two stored builds of which few rows differ: only the folders whose sums differ are compared."""
    o = T(spark, sf_dir).raw("orders")
    a = o.select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("double").alias("cost"), F.year("o_orderdate").alias("order_year"))
    b = a.where(f"not ({_LOST})").withColumn("cost", F.col("cost") + F.when(F.expr(_CHANGED), 1).otherwise(0))
    paths = [M.work_dir(spark, f"build-{n}") for n in "ab"]
    for df, path in zip((a, b), paths):
        B.store_build(df, path, "order_year", ["o_orderkey"], buckets=8)
    return B.diff_builds(spark, *paths, a, "order_year")


@register("benchmarks_json", REGISTRY["cost_benchmarking"][1])
def q_benchmarks_json(spark, sf_dir):
    """SRC-13: the cost-benchmark mart exported as JSON records, and read again from them."""
    t = T(spark, sf_dir)
    mart = A.cost_benchmarking(t.encounters(), calendar=t.calendar)
    path = M.work_dir(spark, "benchmarks-json")
    M.records_json(mart).write.text(path)
    return spark.read.text(path).select(F.from_json("value", mart.schema).alias("r")).select("r.*")


_REF_SQL = f"'{codes.MASK_PREFIX}' || sha256(patient_id)"


@register("audit_disclosure", sql_with(["patient", "condition"], f"""SELECT {_REF_SQL} AS patient_ref,
  1 + (d.patient_key IS NOT NULL)::INTEGER::BIGINT AS accesses, 1 + (d.patient_key IS NOT NULL)::INTEGER::BIGINT AS actions
FROM (SELECT patient_id, patient_key FROM patient UNION ALL SELECT 'nobody', NULL) p
LEFT JOIN (SELECT patient_key FROM condition WHERE code IN ({', '.join(repr(c) for c in codes.DRIVER_CONDITION_SETS['diabetes'])})
           GROUP BY patient_key) d ON d.patient_key = p.patient_key"""))
def q_audit_disclosure(spark, sf_dir):
    """GOV-03/04: every requested patient gets an audit row, written before the read, also one
    that does not exist; the disclosure report lists the accesses within the retention window."""
    t = T(spark, sf_dir)
    path = M.work_dir(spark, "audit")
    asked = t.patients().select("patient_id").unionAll(spark.createDataFrame([("nobody",)], "patient_id string"))
    GOV.audited(asked, path, action="features_read", accessor="batch", context={"query": "features"})
    feats = FE.patient_features(
        t.patients(), t.encounters(), t.conditions(), condition_sets=t.condition_sets, as_of=t.as_of
    )
    GOV.audited(feats.where(F.col("has_diabetes") == 1).select("patient_id"), path, action="care_gaps_read", accessor="batch")
    return GOV.disclosure_summary(spark.read.parquet(path)).select("patient_ref", "accesses", "actions")


_LOG_SQL = f"""log AS (SELECT {_REF_SQL} AS patient_ref, DATE '2010-01-01' + CAST(patient_key * 37 % 5000 AS INTEGER) AS day, patient_key FROM patient)"""


def _log(spark, sf_dir):
    """A log of one access per patient, on days over almost 14 years, written by day; its folder."""
    p = T(spark, sf_dir).patients()
    ids = GOV.audit_rows(p.select("patient_id"), action="features_read", accessor="batch", context={"query": "log"}).drop("access_date")
    day = F.date_add(F.lit("2010-01-01").cast("date"), (F.col("patient_key") * 37 % 5000).cast("int"))
    days = p.select(mask_value(F.col("patient_id"), full_digest=True).alias("patient_ref"), day.alias("day"))
    log = ids.join(days, "patient_ref").withColumn("accessed_at", F.col("day").cast("timestamp"))
    # by year, so that there are few folders: the first day stands for its year
    path = M.work_dir(spark, "audit-log")
    M.write_mart(log.withColumn("access_date", F.trunc("day", "year")).drop("day"), path, ["access_date"], mode="full")
    return path


@register("audit_chain", sql_with(["patient"], f"""{{LOG}}
SELECT date_trunc('year', day)::DATE AS access_date, right(sha256(patient_ref), 2) AS segment, count(*) AS entries,
  count_if(patient_key % 11 = 3)::BIGINT AS missing, count_if(patient_key % 11 = 3) = 0 AS intact
FROM log GROUP BY 1, 2""".replace("{LOG}", f"WITH {_LOG_SQL}")))
def q_audit_chain(spark, sf_dir):
    """GOV-03: entries that were removed after their days were sealed show in their segments' chains, and only there."""
    path = _log(spark, sf_dir)
    chain = path + "-chain"
    log = spark.read.parquet(path)      # one access per patient: never empty
    GOV.seal_days(log, chain)
    p = T(spark, sf_dir).patients().where("patient_key % 11 = 3").select(mask_value(F.col("patient_id"), full_digest=True).alias("patient_ref"))
    return GOV.verify_chain(log.join(p, "patient_ref", "left_anti"), spark.read.schema(GOV.CHAIN_SCHEMA).parquet(chain))


@register("audit_retention", sql_with(["patient"], f"""{{LOG}}
SELECT date_trunc('year', day)::DATE AS access_date, count(*) AS entries FROM log
WHERE date_trunc('year', day) >= DATE '2017-01-01' GROUP BY 1""".replace("{LOG}", f"WITH {_LOG_SQL}")))
def q_audit_retention(spark, sf_dir):
    """GOV-04: days past seven years are gone from the log, all others whole."""
    path = _log(spark, sf_dir)
    GOV.expire_days(spark, path, as_of="2023-06-15")
    left = spark.read.schema("patient_ref string, access_date date").parquet(path)
    return left.groupBy("access_date").agg(F.count(F.lit(1)).alias("entries"))


@register("risk_scores", sql_with(["patient", "encounter_base", "condition"], f"""WITH r AS (
  SELECT patient_id, row_number() OVER (ORDER BY coalesce(healthcare_expenses, 0) DESC, patient_key) AS place, count(*) OVER () AS n FROM patient)
SELECT '{codes.MASK_PREFIX}' || left(sha256(patient_id), {codes.MASK_HEX_CHARS}) AS patient_id, '{codes.MODEL_VERSION}' AS model_version,
  (place <= greatest(1, n // 4))::INTEGER AS label, true AS in_bounds FROM r"""))
def q_risk_scores(spark, sf_dir):
    """MRT-09: fit once on all patients (rank label), score every patient: who is scored, with which label
    learned, and that each score is a probability (how the fit compares is a test's matter)."""
    from carespark.session import stable_table

    t = T(spark, sf_dir)
    feats = stable_table(FE.patient_features(
        t.patients(), t.encounters(), t.conditions(), condition_sets=t.condition_sets, as_of=t.as_of
    ), "features")
    labels = FE.high_cost_label(feats.select("patient_key", "patient_id", "healthcare_expenses"))
    train, n = R.training_frame(feats, labels)
    model = R.fit(stable_table(train, "training"), n)
    scored = R.score(model, feats, phi_read=True).join(labels.select("patient_id", "label"), "patient_id")
    return scored.select(mask_value(F.col("patient_id")).alias("patient_id"), "model_version", F.col("label").cast("int").alias("label"),
                         F.col("risk_score").between(0, 1).alias("in_bounds"))


@register("risk_certificate", " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST(0 AS DOUBLE) AS gradient" for f in [*codes.RISK_FEATURES, "intercept"]))
def q_risk_certificate(spark, sf_dir):
    """MRT-09/ML-06: the fitted coefficients are the optimum of the penalised loss: every gradient rounds to 0."""
    from carespark.session import stable_table

    t = T(spark, sf_dir)
    feats = stable_table(FE.patient_features(
        t.patients(), t.encounters(), t.conditions(), condition_sets=t.condition_sets, as_of=t.as_of), "features")
    train, n = R.training_frame(feats, FE.high_cost_label(feats.select("patient_key", "healthcare_expenses")))
    train = stable_table(train, "training")
    found = R.optimality(R.fit(train, n), train, n)
    return found.select("feature", (F.round("gradient", 5) + F.lit(0.0)).alias("gradient"))


def _mart(spark, name, df, layout):
    """A mart that holds something else, then a full build of it, then read back."""
    path = M.work_dir(spark, name)
    M.write_mart(df.limit(1), path, layout, mode="full")
    M.write_mart(df, path, layout, mode="full")
    return spark.read.parquet(path)


@register("mart_patient_conditions", REGISTRY["condition_flags"][1])
def q_mart_patient_conditions(spark, sf_dir):
    """MRT-10/P14: the per-patient condition flags as a mart that cohorts and features can share."""
    t = T(spark, sf_dir)
    flags = A.patient_condition_flags(t.conditions(), t.condition_sets)
    return _mart(spark, "mart-conditions", flags, ["has_diabetes"]).select(
        "patient_key", "condition_count", "has_diabetes", "has_heart_failure", "has_copd_asthma", "has_hypertension")


@register("mart_cost_summary", REGISTRY["cost_benchmarking"][1])
def q_mart_cost_summary(spark, sf_dir):
    """MRT-10: the cost mart by year; a stale year is replaced by a refresh of that year only."""
    t = T(spark, sf_dir)
    fresh = A.cost_benchmarking(t.encounters(), calendar=t.calendar)
    years = t.encounters().agg(F.min(F.year("start_date")), F.max(F.year("start_date"))).first()
    stale = F.col("encounter_year").isin(years[0], years[1])
    path = M.work_dir(spark, "mart-cost")
    M.write_mart(fresh.withColumn("max_cost", F.when(stale, -1.0).otherwise(F.col("max_cost"))), path, ["encounter_year"], mode="full")
    M.write_mart(fresh.where(stale), path, ["encounter_year"], mode="dynamic")
    return spark.read.parquet(path).select(*fresh.columns)


@register("mart_care_gaps", REGISTRY["patient_care_gaps"][1])
def q_mart_care_gaps(spark, sf_dir):
    """MRT-10: the care-gap mart by whether there is a gap, rebuilt over an older one."""
    t = T(spark, sf_dir)
    gaps = G.patient_care_gaps(t.patients(), t.encounters(), t.conditions(), as_of=t.as_of, calendar=t.calendar)
    return _mart(spark, "mart-gaps", gaps.withColumn("has_gap", (F.col("gap_count") > 0).cast("int")), ["has_gap"]).select(*gaps.columns)
