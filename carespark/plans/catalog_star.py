"""Registered queries: star-schema build, keys, data quality, scalars, calendar.

Dirty text for the cast operators is derived from the driver tables the same
way on both sides (blank, junk suffix, impossible dates, exponent forms).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from carespark.functions import columns as C
from carespark.operators import calendar as CAL
from carespark.operators.keys import append_with_keys, insert_if_absent
from carespark.operators.quality import check_unique, fk_violations
from carespark.plans.catalog import AS_OF, CAL as DCAL, T, register
from carespark.plans.star import build_star, schema_conform, typed_encounters
from carespark.sources.contracts import STAR_SCHEMAS
from carespark.sources.driver import sql_with
from carespark.sources.driver_raw import raw_tables, star_sql_ctes

SPLIT_EXISTING_BEFORE = "1998-01-01"  # rows stored by an earlier load
SPLIT_INCOMING_FROM = "1997-01-01"  # the new batch overlaps one year


def _star(spark, sf_dir, targets):
    t = T(spark, sf_dir)
    return build_star(spark, raw_tables(t), calendar=t.calendar, targets=targets)


def _star_sql(tables: list[str], body: str) -> str:
    return sql_with(["patient", "encounter"], body, extra=star_sql_ctes(tables))


def _dbl(*cols):
    return [F.col(c).cast("double").alias(c) for c in cols]


# -- calendar ----------------------------------------------------------------
_CAL_SQL = f"""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
  CAST(year(d) AS SMALLINT) AS year, CAST(month(d) AS SMALLINT) AS month,
  CAST(day(d) AS SMALLINT) AS day, CAST(quarter(d) AS SMALLINT) AS quarter,
  CAST(dayofweek(d) AS SMALLINT) AS day_of_week
FROM (SELECT CAST(generate_series AS DATE) AS d
      FROM generate_series(DATE '{DCAL[0]}', DATE '{DCAL[1]}', INTERVAL 1 DAY))"""


@register("dim_date", """WITH span AS (SELECT CAST(least(min(o.o_orderdate), min(l.l_shipdate)) AS DATE) AS lo,
    CAST(greatest(max(o.o_orderdate), max(l.l_shipdate)) AS DATE) AS hi
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey),
days AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS full_date FROM span)
SELECT year(full_date)::INTEGER * 10000 + month(full_date)::INTEGER * 100 + day(full_date)::INTEGER AS date_key, full_date,
  year(full_date)::SMALLINT AS year, month(full_date)::SMALLINT AS month, day(full_date)::SMALLINT AS day,
  quarter(full_date)::SMALLINT AS quarter, dayofweek(full_date)::SMALLINT AS day_of_week FROM days""")
def q_dim_date(spark, sf_dir):
    """GEN-01/STR-01: the calendar over the range of the encounters' own dates."""
    e = T(spark, sf_dir).encounters_with_stop().where(F.col("stop_date").isNotNull())
    return CAL.calendar_dim(spark, CAL.date_range(e, "start_date", "stop_date"))


_ENC_KEYS_SQL = """SELECT encounter_key, CAST(strftime(start_date, '%Y%m%d') AS INTEGER) AS start_date_key,
  CAST(strftime(stop_date, '%Y%m%d') AS INTEGER) AS stop_date_key FROM encounter"""


def _enc_keys(spark, sf_dir):
    t = T(spark, sf_dir)
    return t.encounters_with_stop().select(
        "encounter_key",
        C.date_key("start_date").alias("start_date_key"),
        C.date_key("stop_date").alias("stop_date_key"),
    )


@register(
    "calendar_join",
    sql_with(["encounter"], f"""WITH fe AS ({_ENC_KEYS_SQL}), cal AS ({_CAL_SQL})
SELECT fe.encounter_key, cal.date_key, cal.year, cal.quarter, cal.day_of_week
FROM fe JOIN cal ON cal.date_key = fe.start_date_key"""),
)
def q_calendar_join(spark, sf_dir):
    """JOI-01: inner join to the (size-checked, broadcast) calendar."""
    j = CAL.join_calendar(_enc_keys(spark, sf_dir), CAL.calendar_dim(spark, DCAL), "start_date_key", "s_")
    return j.select(
        "encounter_key", F.col("s_date_key").alias("date_key"), F.col("s_year").alias("year"),
        F.col("s_quarter").alias("quarter"), F.col("s_day_of_week").alias("day_of_week"),
    )


@register(
    "role_playing_calendar",
    sql_with(["encounter"], f"""WITH fe AS ({_ENC_KEYS_SQL}), cal AS ({_CAL_SQL})
SELECT fe.encounter_key, s.year AS start_year, s.quarter AS start_quarter,
  e.year AS stop_year, e.day_of_week AS stop_day_of_week
FROM fe JOIN cal s ON s.date_key = fe.start_date_key JOIN cal e ON e.date_key = fe.stop_date_key"""),
)
def q_role_playing_calendar(spark, sf_dir):
    """JOI-02: the calendar joined twice (start, stop); open stays drop out."""
    cal = CAL.calendar_dim(spark, DCAL)
    j = CAL.join_calendar(_enc_keys(spark, sf_dir), cal, "start_date_key", "s_")
    j = CAL.join_calendar(j, cal, "stop_date_key", "e_")
    return j.select(
        "encounter_key", F.col("s_year").alias("start_year"), F.col("s_quarter").alias("start_quarter"),
        F.col("e_year").alias("stop_year"), F.col("e_day_of_week").alias("stop_day_of_week"),
    )


@register("date_key", sql_with(["encounter"], _ENC_KEYS_SQL))
def q_date_key(spark, sf_dir):
    return _enc_keys(spark, sf_dir)


@register(
    "date_parts",
    sql_with(["encounter_base"], """SELECT encounter_key, CAST(year(start_date) AS SMALLINT) AS year,
  CAST(month(start_date) AS SMALLINT) AS month, CAST(day(start_date) AS SMALLINT) AS day,
  CAST(quarter(start_date) AS SMALLINT) AS quarter, CAST(dayofweek(start_date) AS SMALLINT) AS day_of_week
FROM encounter_base"""),
)
def q_date_parts(spark, sf_dir):
    return T(spark, sf_dir).encounters().select("encounter_key", *C.date_parts("start_date"))


@register(
    "date_diff_days",
    sql_with(["encounter"], """SELECT encounter_key, CAST(date_diff('day', start_date, stop_date) AS INTEGER) AS length_of_stay,
  CAST(date_diff('day', stop_date, DATE '2001-12-31') AS INTEGER) AS days_since_discharge FROM encounter"""),
)
def q_date_diff_days(spark, sf_dir):
    e = T(spark, sf_dir).encounters_with_stop()
    return e.select(
        "encounter_key",
        C.days_between("stop_date", "start_date").alias("length_of_stay"),
        C.days_between(F.to_date(F.lit(AS_OF)), "stop_date").alias("days_since_discharge"),
    )


@register(
    "year_boundary_diff",
    sql_with(["patient"], f"""SELECT patient_key, birthdate,
  CAST(date_diff('year', birthdate, DATE '{AS_OF}') AS INTEGER) AS age_years FROM patient"""),
)
def q_year_boundary_diff(spark, sf_dir):
    p = T(spark, sf_dir).patients()
    return p.select(
        "patient_key", "birthdate",
        C.year_boundary_age(F.to_date(F.lit(AS_OF)), "birthdate").alias("age_years"),
    )


# -- casts on derived dirty text -------------------------------------------------
_MONEY_SQL = "CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR)"
_DEC_TEXT_SQL = f"""CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN {_MONEY_SQL} || 'x'
  WHEN c_custkey % 13 = 0 THEN '123456789012.5' ELSE {_MONEY_SQL} || '5' END"""


def _dec_text():
    k = F.col("c_custkey")
    money = F.col("c_acctbal").cast("decimal(12,2)").cast("string")
    return (
        F.when(k % 7 == 0, F.lit(""))
        .when(k % 11 == 0, F.concat(money, F.lit("x")))
        .when(k % 13 == 0, F.lit("123456789012.5"))
        .otherwise(F.concat(money, F.lit("5")))
    )


@register(
    "try_cast_decimal",
    f"""SELECT c_custkey AS patient_key, {_DEC_TEXT_SQL} AS raw_text,
  CAST(TRY_CAST({_DEC_TEXT_SQL} AS DECIMAL(12,2)) AS DOUBLE) AS parsed FROM customer""",
)
def q_try_cast_decimal(spark, sf_dir):
    c = T(spark, sf_dir).raw("customer").select("c_custkey", _dec_text().alias("raw_text"))
    return c.select(
        F.col("c_custkey").alias("patient_key"), "raw_text",
        C.try_decimal("raw_text", 12, 2).cast("double").alias("parsed"),
    )


# texts that show how a cast rounds and what it accepts, among the generated ones
_INT_PROBES = ["12.4999999", "0.4999999", "2147483647.4999999", "2147483647.5", "1_000", "1__000", "0x1F", "-0x1F", "0b11",
               "-12.5", ".5", "7.", ".", "1.25e1", "5e-1", " 7 ", "+5", "12.4999999999999999999999", "-0.5", "1_0.5"]
_INT_TEXT_SQL = f"""CASE l_orderkey % 97 {' '.join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(_INT_PROBES))}
  ELSE CASE l_linenumber % 4 WHEN 0 THEN CAST(l_quantity AS VARCHAR)
  WHEN 1 THEN '-' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.5'
  WHEN 2 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || 'e1'
  ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.7x' END END"""


@register(
    "try_cast_integer",
    f"""SELECT l_orderkey, l_linenumber, {_INT_TEXT_SQL} AS raw_text,
  TRY_CAST({_INT_TEXT_SQL} AS INTEGER) AS parsed FROM lineitem""",
)
def q_try_cast_integer(spark, sf_dir):
    li = T(spark, sf_dir).raw("lineitem")
    q = F.col("l_quantity")
    qi = q.cast("int").cast("string")
    ln = F.col("l_linenumber") % 4
    text = (
        F.when(ln == 0, q.cast("string"))
        .when(ln == 1, F.concat(F.lit("-"), qi, F.lit(".5")))
        .when(ln == 2, F.concat(qi, F.lit("e1")))
        .otherwise(F.concat(qi, F.lit(".7x")))
    )
    for i, t in enumerate(_INT_PROBES):
        text = F.when(F.col("l_orderkey") % 97 == i, t).otherwise(text)
    t = li.select("l_orderkey", "l_linenumber", text.alias("raw_text"))
    return t.withColumn("parsed", C.try_integer("raw_text"))


_ISO_SQL = "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"
_DATE_PROBES = ["2022-01/05", "2022/01/05", "2022/1/5", "2022-1-5", "2022 01 05", "2022-01-5x", "2022/1/05 ", "2022-1-05T", "2022-13-01"]
_DATE_TEXT_SQL = f"""CASE {' '.join(f"WHEN o_orderkey % 61 = {i} THEN '{t}'" for i, t in enumerate(_DATE_PROBES))}
  WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 11 = 0 THEN substr({_ISO_SQL}, 1, 7)
  WHEN o_orderkey % 13 = 0 THEN CAST(year(o_orderdate) AS VARCHAR) || '-02-30'
  ELSE {_ISO_SQL} || 'T08:30:00Z' END"""


@register(
    "iso_prefix_to_date",
    f"""SELECT o_orderkey, {_DATE_TEXT_SQL} AS raw_text,
  TRY_CAST(substr({_DATE_TEXT_SQL}, 1, 10) AS DATE) AS parsed FROM orders""",
)
def q_iso_prefix_to_date(spark, sf_dir):
    o = T(spark, sf_dir).raw("orders")
    k = F.col("o_orderkey")
    iso = F.col("o_orderdate").cast("date").cast("string")
    text = (
        F.when(k % 7 == 0, F.lit(""))
        .when(k % 11 == 0, F.substring(iso, 1, 7))
        .when(k % 13 == 0, F.concat(F.year("o_orderdate").cast("string"), F.lit("-02-30")))
        .otherwise(F.concat(iso, F.lit("T08:30:00Z")))
    )
    for i, t in enumerate(_DATE_PROBES):
        text = F.when(k % 61 == i, t).otherwise(text)
    return o.select("o_orderkey", text.alias("raw_text")).withColumn(
        "parsed", C.iso_prefix_to_date("raw_text")
    )


_YMD_SQL = f"""CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 11 = 0 THEN CAST(year(o_orderdate) AS VARCHAR) || '0230'
  WHEN o_orderkey % 13 = 0 THEN {_ISO_SQL} ELSE strftime(CAST(o_orderdate AS DATE), '%Y%m%d') END"""


@register(
    "yyyymmdd_to_date",
    f"""SELECT o_orderkey, {_YMD_SQL} AS raw_text,
  CAST(TRY_STRPTIME({_YMD_SQL}, '%Y%m%d') AS DATE) AS parsed FROM orders""",
)
def q_yyyymmdd_to_date(spark, sf_dir):
    o = T(spark, sf_dir).raw("orders")
    k = F.col("o_orderkey")
    d = F.col("o_orderdate").cast("date")
    text = (
        F.when(k % 7 == 0, F.lit(""))
        .when(k % 11 == 0, F.concat(F.year(d).cast("string"), F.lit("0230")))
        .when(k % 13 == 0, d.cast("string"))
        .otherwise(F.date_format(d, "yyyyMMdd"))
    )
    return o.select("o_orderkey", text.alias("raw_text")).withColumn(
        "parsed", C.yyyymmdd_to_date("raw_text")
    )


@register(
    "blank_to_null",
    f"""SELECT l_orderkey, l_linenumber,
  NULLIF(CASE WHEN l_linestatus = 'O' THEN '' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END, '') AS stop_text
FROM lineitem""",
)
def q_blank_to_null(spark, sf_dir):
    li = T(spark, sf_dir).raw("lineitem")
    text = F.when(F.col("l_linestatus") == "O", F.lit("")).otherwise(
        F.col("l_shipdate").cast("date").cast("string")
    )
    return li.select("l_orderkey", "l_linenumber", C.blank_to_null(text).alias("stop_text"))


@register(
    "active_episode_flag",
    f"""WITH r AS (SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linestatus = 'O' THEN '' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS stop_text FROM lineitem)
SELECT l_orderkey, l_linenumber,
  CASE WHEN NULLIF(stop_text, '') IS NOT NULL THEN CAST(strftime(TRY_CAST(substr(stop_text, 1, 10) AS DATE), '%Y%m%d') AS INTEGER) END AS stop_date_key,
  CASE WHEN NULLIF(stop_text, '') IS NULL THEN 1 ELSE 0 END AS is_active
FROM r""",
)
def q_active_episode_flag(spark, sf_dir):
    li = T(spark, sf_dir).raw("lineitem")
    text = F.when(F.col("l_linestatus") == "O", F.lit("")).otherwise(
        F.col("l_shipdate").cast("date").cast("string")
    )
    r = li.select("l_orderkey", "l_linenumber", text.alias("stop_text"))
    key = C.date_key(C.optional_date("stop_text"))
    return r.select(
        "l_orderkey", "l_linenumber", key.alias("stop_date_key"),
        F.when(C.blank_to_null("stop_text").isNull(), 1).otherwise(0).alias("is_active"),
    )


@register(
    "decode_flags",
    """SELECT l_orderkey, l_linenumber,
  CASE WHEN c = '1' THEN TRUE WHEN c = '2' THEN FALSE END AS returned,
  CASE WHEN upper(s) = 'Y' THEN TRUE WHEN upper(s) = 'N' THEN FALSE END AS still_open,
  CASE WHEN c = '1' THEN 'M' WHEN c = '2' THEN 'F' END AS sex
FROM (SELECT l_orderkey, l_linenumber,
        CASE l_returnflag WHEN 'R' THEN '1' WHEN 'A' THEN '2' ELSE '9' END AS c,
        CASE l_linestatus WHEN 'O' THEN 'y' WHEN 'F' THEN 'N' ELSE '?' END AS s FROM lineitem)""",
)
def q_decode_flags(spark, sf_dir):
    """SCL-26: legacy 1/2, Y/N and sex codes decoded."""
    li = T(spark, sf_dir).raw("lineitem")
    r = li.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "R", "1").when(F.col("l_returnflag") == "A", "2")
        .otherwise("9").alias("c"),
        F.when(F.col("l_linestatus") == "O", "y").when(F.col("l_linestatus") == "F", "N")
        .otherwise("?").alias("s"),
    )
    return r.select(
        "l_orderkey", "l_linenumber", C.decode_yes_no_12("c").alias("returned"),
        C.decode_yn("s").alias("still_open"), C.decode_sex("c").alias("sex"),
    )


@register(
    "result_decimal_to_double",
    sql_with(["encounter_base"], """SELECT encounter_class, CAST(SUM(total_claim_cost) AS DOUBLE) AS total_cost,
  CAST(MAX(total_claim_cost) AS DOUBLE) AS max_cost, CAST(MIN(total_claim_cost) AS DOUBLE) AS min_cost
FROM encounter_base GROUP BY encounter_class"""),
)
def q_result_decimal_to_double(spark, sf_dir):
    """SRC-12: decimal results leave as DOUBLE."""
    e = T(spark, sf_dir).encounters()
    return e.groupBy("encounter_class").agg(
        C.to_double(F.sum("total_claim_cost")).alias("total_cost"),
        C.to_double(F.max("total_claim_cost")).alias("max_cost"),
        C.to_double(F.min("total_claim_cost")).alias("min_cost"),
    )


# -- star tables -----------------------------------------------------------------
@register(
    "dim_patient",
    _star_sql(["dim_patient"], """SELECT patient_key, patient_id, birthdate, gender, state,
  CAST(healthcare_expenses AS DOUBLE) AS healthcare_expenses, income FROM dim_patient"""),
)
def q_dim_patient(spark, sf_dir):
    d = _star(spark, sf_dir, ["dim_patient"]).tables["dim_patient"]
    return d.select("patient_key", "patient_id", "birthdate", "gender", "state",
                    *_dbl("healthcare_expenses"), "income")


@register("dim_provider", _star_sql(["dim_provider"], "SELECT * FROM dim_provider"))
def q_dim_provider(spark, sf_dir):
    d = _star(spark, sf_dir, ["dim_provider"]).tables["dim_provider"]
    return d.select("provider_key", "provider_id", "name", "speciality", "state")


@register("code_dictionary", _star_sql(["dim_condition_code"], "SELECT * FROM dim_condition_code"))
def q_code_dictionary(spark, sf_dir):
    return _star(spark, sf_dir, ["dim_condition_code"]).tables["dim_condition_code"]


@register(
    "fact_encounter",
    _star_sql(["fact_encounter"], """SELECT encounter_key, patient_key, provider_key, start_date_key,
  stop_date_key, encounter_id, encounter_class, CAST(base_cost AS DOUBLE) AS base_cost,
  CAST(total_claim_cost AS DOUBLE) AS total_claim_cost FROM fact_encounter"""),
)
def q_fact_encounter(spark, sf_dir):
    d = _star(spark, sf_dir, ["fact_encounter"]).tables["fact_encounter"]
    return d.select("encounter_key", "patient_key", "provider_key", "start_date_key", "stop_date_key",
                    "encounter_id", "encounter_class", *_dbl("base_cost", "total_claim_cost"))


@register("fact_condition", _star_sql(["fact_condition"], "SELECT * FROM fact_condition"))
def q_fact_condition(spark, sf_dir):
    return _star(spark, sf_dir, ["fact_condition"]).tables["fact_condition"]


@register(
    "star_orphans",
    _star_sql(["raw_conditions"], """SELECT "PATIENT" AS patient_id, COUNT(*) AS conditions,
  COUNT(DISTINCT "CODE") AS codes, CAST(0 AS BIGINT) AS inserted_again
FROM raw_conditions WHERE CAST(substr("PATIENT", 10) AS BIGINT) % 10 = 0 GROUP BY 1"""),
)
def q_star_orphans(spark, sf_dir):
    """STR-06 with a tenth of the patients unknown, default arguments: every orphan
    condition is kept under its raw patient id, and loading again inserts nothing."""
    from carespark.session import stable_table

    t = T(spark, sf_dir)
    raw = raw_tables(t)
    raw["raw_patients"] = raw["raw_patients"].where(F.substring("ID", 10, 20).cast("long") % 10 != 0)
    first = build_star(spark, raw, calendar=t.calendar, targets=["fact_condition"])
    stored = {n: stable_table(d, n) for n, d in first.tables.items()}
    again = build_star(spark, raw, existing=stored, calendar=t.calendar, targets=["fact_condition"]).appended["fact_condition"]
    more = again.groupBy("patient_id").agg(F.count(F.lit(1)).alias("inserted_again"))
    return stored["fact_condition"].where(F.col("patient_key").isNull()).groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("conditions"), F.countDistinct("snomed_code").alias("codes")
    ).join(more, "patient_id", "left").na.fill(0, ["inserted_again"])


@register(
    "star_duplicates",
    _star_sql(["raw_conditions"], """SELECT "PATIENT" AS patient_id, "CODE" AS snomed_code, "START" AS start_text,
  COUNT(*) AS stored, COUNT(*) - 1 AS removed
FROM raw_conditions GROUP BY 1, 2, 3 HAVING COUNT(*) > 1"""),
)
def q_star_duplicates(spark, sf_dir):
    """STR-06: episodes that share patient, code and day all stay by default; with
    ``dedupe`` one stays and the rows removed are counted."""
    t = T(spark, sf_dir)
    key = ["patient_id", "snomed_code", "start_date_key"]
    plain = _star(spark, sf_dir, ["fact_condition"]).tables["fact_condition"]
    stored = plain.groupBy(*key).agg(F.count(F.lit(1)).alias("stored")).where("stored > 1")
    b = build_star(spark, raw_tables(t), calendar=t.calendar, dedupe=True, targets=["fact_condition"])
    removed = b.duplicates["fact_condition"].groupBy(*key).agg(F.sum("occurrences").alias("removed"))
    return stored.join(removed, key).select(
        "patient_id", "snomed_code", C.date_from_key("start_date_key").cast("string").alias("start_text"), "stored", "removed")


@register(
    "fact_medication",
    _star_sql(["fact_medication"], """SELECT ROW_NUMBER() OVER (ORDER BY patient_key NULLS FIRST,
    rxnorm_code NULLS FIRST, start_date_key NULLS FIRST, encounter_key NULLS FIRST,
    stop_date_key NULLS FIRST, total_cost NULLS FIRST, dispenses NULLS FIRST, base_cost NULLS FIRST) AS medication_key,
  patient_key, encounter_key, start_date_key, stop_date_key, rxnorm_code,
  CAST(total_cost AS DOUBLE) AS total_cost, dispenses FROM fact_medication"""),
)
def q_fact_medication(spark, sf_dir):
    d = _star(spark, sf_dir, ["fact_medication"]).tables["fact_medication"]
    return d.select("medication_key", "patient_key", "encounter_key", "start_date_key",
                    "stop_date_key", "rxnorm_code", *_dbl("total_cost"), "dispenses")


@register(
    "star_schema_conform",
    sql_with(["encounter"], """SELECT encounter_key, patient_key, provider_key,
  CAST(strftime(start_date, '%Y%m%d') AS INTEGER) AS start_date_key,
  CAST(strftime(stop_date, '%Y%m%d') AS INTEGER) AS stop_date_key, encounter_id, encounter_class,
  CAST(NULL AS VARCHAR) AS description, CAST(NULL AS DOUBLE) AS base_cost,
  CAST(total_claim_cost AS DOUBLE) AS total_claim_cost, CAST(NULL AS DOUBLE) AS payer_coverage,
  CAST(NULL AS VARCHAR) AS reason_code, CAST(NULL AS VARCHAR) AS reason_description FROM encounter"""),
)
def q_star_schema_conform(spark, sf_dir):
    """SRC-10: conform a frame to the fact_encounter schema (order, types, NULL fill)."""
    e = T(spark, sf_dir).encounters_with_stop().withColumn(
        "start_date_key", C.date_key("start_date")
    ).withColumn("stop_date_key", C.date_key("stop_date"))
    out = schema_conform(e, STAR_SCHEMAS["fact_encounter"])
    return out.select(*[
        F.col(c).cast("double").alias(c) if c in ("base_cost", "total_claim_cost", "payer_coverage")
        else F.col(c) for c in out.columns
    ])


_ORPHAN_CLASS = "5-LOW"


@register(
    "fact_key_lookup",
    _star_sql(["dim_patient", "dim_provider", "raw_encounters"], f"""SELECT r."Id" AS encounter_id, dp.patient_key, pv.provider_key
FROM (SELECT "Id", CASE WHEN "ENCOUNTERCLASS" = '{_ORPHAN_CLASS}' THEN "PATIENT" || '-unknown' ELSE "PATIENT" END AS "PATIENT",
        "PROVIDER" FROM raw_encounters) r
LEFT JOIN dim_patient dp ON dp.patient_id = r."PATIENT" LEFT JOIN dim_provider pv ON pv.provider_id = r."PROVIDER\""""),
)
def q_fact_key_lookup(spark, sf_dir):
    """JOI-03: left lookups of surrogate keys; orphans keep a NULL key."""
    t = T(spark, sf_dir)
    raw = raw_tables(t)
    b = build_star(spark, raw, calendar=t.calendar, targets=["dim_patient", "dim_provider"])
    re = raw["raw_encounters"].withColumn(
        "PATIENT",
        F.when(F.col("ENCOUNTERCLASS") == _ORPHAN_CLASS, F.concat("PATIENT", F.lit("-unknown")))
        .otherwise(F.col("PATIENT")),
    )
    e = typed_encounters(re, b.tables["dim_patient"], b.tables["dim_provider"])
    return e.select("encounter_id", "patient_key", "provider_key")


def _split_encounters(spark, sf_dir):
    e = T(spark, sf_dir).encounters().drop("total_claim_cost")
    existing = e.where(F.col("start_date") < F.to_date(F.lit(SPLIT_EXISTING_BEFORE)))
    incoming = e.where(F.col("start_date") >= F.to_date(F.lit(SPLIT_INCOMING_FROM)))
    return existing, incoming


_SPLIT_E = f"(SELECT * FROM encounter_base WHERE start_date < DATE '{SPLIT_EXISTING_BEFORE}')"
_SPLIT_I = f"(SELECT * FROM encounter_base WHERE start_date >= DATE '{SPLIT_INCOMING_FROM}')"


@register(
    "insert_if_absent",
    sql_with(["encounter_base"], f"""SELECT i.encounter_id, i.patient_key, i.start_date, i.encounter_class
FROM {_SPLIT_I} i WHERE NOT EXISTS (SELECT 1 FROM {_SPLIT_E} e WHERE e.encounter_id = i.encounter_id)"""),
)
def q_insert_if_absent(spark, sf_dir):
    """JOI-06: new rows of an overlapping batch (anti-join on the natural key)."""
    existing, incoming = _split_encounters(spark, sf_dir)
    new = insert_if_absent(incoming, existing, ["encounter_id"])
    return new.select("encounter_id", "patient_key", "start_date", "encounter_class")


@register(
    "surrogate_key_append",
    sql_with(["encounter_base"], f"""WITH new AS (SELECT i.* FROM {_SPLIT_I} i
  WHERE NOT EXISTS (SELECT 1 FROM {_SPLIT_E} e WHERE e.encounter_id = i.encounter_id))
SELECT encounter_id, ROW_NUMBER() OVER (ORDER BY encounter_id) + (SELECT MAX(encounter_key) FROM {_SPLIT_E}) AS encounter_key
FROM new"""),
)
def q_surrogate_key_append(spark, sf_dir):
    """WIN-04/JOI-10: keys continue after the stored maximum, in natural-key order."""
    existing, incoming = _split_encounters(spark, sf_dir)
    new = append_with_keys(
        incoming.drop("encounter_key").select("encounter_id"), existing, ["encounter_id"], "encounter_key"
    )
    return new.select("encounter_id", "encounter_key")


_COND_KEYED = """(SELECT patient_key, code, start_date, description, encounter_key FROM condition)"""


@register(
    "insert_if_absent_composite",
    sql_with(["condition"], f"""WITH c AS {_COND_KEYED}
SELECT i.patient_key, i.code, i.start_date, i.description, i.encounter_key
FROM (SELECT * FROM c WHERE start_date >= DATE '{SPLIT_INCOMING_FROM}') i
WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM c WHERE start_date < DATE '{SPLIT_EXISTING_BEFORE}') e
  WHERE e.patient_key IS NOT DISTINCT FROM i.patient_key AND e.code IS NOT DISTINCT FROM i.code
    AND e.start_date IS NOT DISTINCT FROM i.start_date)"""),
)
def q_insert_if_absent_composite(spark, sf_dir):
    """JOI-07: composite natural key, NULL-safe guard."""
    c = T(spark, sf_dir).conditions().select(
        "patient_key", "code", "start_date", "description", "encounter_key"
    )
    existing = c.where(F.col("start_date") < F.to_date(F.lit(SPLIT_EXISTING_BEFORE)))
    incoming = c.where(F.col("start_date") >= F.to_date(F.lit(SPLIT_INCOMING_FROM)))
    return insert_if_absent(incoming, existing, ["patient_key", "code", "start_date"])


REF_CAL = ("2000-01-01", "2030-12-31")


@register(
    "dq_fk_violations",
    sql_with(["encounter", "provider"], f"""WITH fe AS ({_ENC_KEYS_SQL.replace('encounter_key,', 'encounter_key, provider_key,')}),
cal AS (SELECT CAST(strftime(CAST(generate_series AS DATE), '%Y%m%d') AS INTEGER) AS date_key
        FROM generate_series(DATE '{REF_CAL[0]}', DATE '{REF_CAL[1]}', INTERVAL 1 DAY))
SELECT 'fk_start_date' AS constraint_name, encounter_key AS row_key, CAST(start_date_key AS VARCHAR) AS bad_value
FROM fe WHERE start_date_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM cal WHERE cal.date_key = fe.start_date_key)
UNION ALL
SELECT 'fk_stop_date', encounter_key, CAST(stop_date_key AS VARCHAR)
FROM fe WHERE stop_date_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM cal WHERE cal.date_key = fe.stop_date_key)
UNION ALL
SELECT 'fk_provider', encounter_key, CAST(provider_key AS VARCHAR)
FROM fe WHERE provider_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM provider p WHERE p.provider_key = fe.provider_key)"""),
)
def q_dq_fk_violations(spark, sf_dir):
    """STR-09: foreign keys of the encounter facts against the reference calendar
    (2000..2030, so earlier dates violate) and the provider dimension."""
    t = T(spark, sf_dir)
    fe = t.encounters_with_stop().select(
        "encounter_key", "provider_key", C.date_key("start_date").alias("start_date_key"), C.date_key("stop_date").alias("stop_date_key"))
    cal = CAL.calendar_dim(spark, REF_CAL)
    return fk_violations(fe, "encounter_key", {
        "fk_start_date": ("start_date_key", cal, "date_key"),
        "fk_stop_date": ("stop_date_key", cal, "date_key"),
        "fk_provider": ("provider_key", t.providers(), "provider_key"),
    })


@register(
    "dq_duplicate_keys",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS occurrences FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
)
def q_dq_duplicate_keys(spark, sf_dir):
    """STR-09: (order, line number) is not a key in the driver data."""
    li = T(spark, sf_dir).raw("lineitem")
    return check_unique(li, ["l_orderkey", "l_linenumber"])


# -- end to end: raw text -> star schema -> mart ----------------------------------
def _star_marts_inputs(spark, sf_dir, targets=("fact_encounter",)):
    from carespark.plans.star import mart_inputs

    b = _star(spark, sf_dir, list(targets))
    return mart_inputs(b.tables)


def _same_sql(key: str) -> str:
    from carespark.plans.catalog import REGISTRY

    return REGISTRY[key][1]


def _dfk(k: str) -> str:
    return f"make_date(CAST({k} // 10000 AS BIGINT), CAST(({k} // 100) % 100 AS BIGINT), CAST({k} % 100 AS BIGINT))"


@register(
    "readmission_rate_from_star",
    _star_sql(["fact_encounter"], f"""WITH stays AS (
  SELECT patient_key, {_dfk('start_date_key')} AS came, {_dfk('stop_date_key')} AS went,
         row_number() OVER (PARTITION BY patient_key ORDER BY start_date_key, encounter_key) AS nth
  FROM fact_encounter
  WHERE encounter_class = '1-URGENT' AND start_date_key BETWEEN {DCAL[0].replace('-', '')} AND {DCAL[1].replace('-', '')}
    AND stop_date_key BETWEEN {DCAL[0].replace('-', '')} AND {DCAL[1].replace('-', '')}
), paired AS (
  SELECT CAST(year(cur.came) AS INTEGER) AS encounter_year, coalesce(cur.came - earlier.went <= 30, false) AS again
  FROM stays cur LEFT JOIN stays earlier
    ON earlier.patient_key IS NOT DISTINCT FROM cur.patient_key AND earlier.nth + 1 = cur.nth
)
SELECT encounter_year, count(*) AS total_admissions, count_if(again)::BIGINT AS readmissions,
       round(avg(CASE WHEN again THEN 100.0::DOUBLE ELSE 0 END), 2) AS readmission_rate_pct
FROM paired GROUP BY encounter_year"""),
)
def q_readmission_rate_from_star(spark, sf_dir):
    """MRT-01 on the star built from the raw text rendering (full pipeline).
    Same-day ties are broken by the star's surrogate key, which follows the
    text id order, so the oracle is computed over the star as well."""
    from carespark.plans import analytics as A
    from carespark.sources.driver import DRIVER_INPATIENT_CLASS

    mi = _star_marts_inputs(spark, sf_dir)
    return A.readmission_rate(mi["encounters"], inpatient_class=DRIVER_INPATIENT_CLASS, calendar=DCAL)


@register("utilization_trends_from_star", _same_sql("utilization_trends"))
def q_utilization_trends_from_star(spark, sf_dir):
    from carespark.plans import analytics as A

    return A.utilization_trends(_star_marts_inputs(spark, sf_dir)["encounters"], calendar=DCAL)


@register("care_gap_rate_from_star", _same_sql("care_gap_rate"))
def q_care_gap_rate_from_star(spark, sf_dir):
    from carespark import codes
    from carespark.plans import analytics as A

    mi = _star_marts_inputs(spark, sf_dir, ("fact_encounter", "fact_condition"))
    return A.care_gap_rate(mi["encounters"], mi["conditions"],
                           code_set=codes.DRIVER_CONDITION_SETS["diabetes"], as_of=AS_OF, calendar=DCAL)
