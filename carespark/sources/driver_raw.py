"""Driver tables rendered as the raw CSV contracts (all text).

This lets the star-schema builder, the casts and the idempotent-append
operators run on data that grows with the driver tables. Dates are printed
as ISO datetimes for encounters (as in the clinical extracts), money as
2-digit text, quantities as float text (``'17.0'``) so the lenient integer
cast is exercised; a condition's blank STOP marks it active.

``RAW_SQL`` is the same rendering for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespark.sources.contracts import CONTRACTS
from carespark.sources.driver import DRIVER_ACTIVE_STATUS, DriverTables, birthdate_of

ID_WIDTH = 9


def _natural_id(prefix: str, key) -> F.Column:
    """Padded with zeros to ID_WIDTH digits; longer keys stay whole."""
    digits = key.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(ID_WIDTH)), F.lit("0")))


def _money(c) -> F.Column:
    return c.cast("decimal(12,2)").cast("string")


def _complete(df: DataFrame, table: str, source: str) -> DataFrame:
    cols = CONTRACTS[table][1]
    have = set(df.columns)
    return df.select(
        *[(F.col(c) if c in have else F.lit(None).cast("string")).alias(c) for c in cols],
        F.lit(source).alias("_source_file"),
    )


def raw_tables(t: DriverTables) -> dict[str, DataFrame]:
    c = t.raw("customer")
    pats = c.withColumn("birthdate", birthdate_of(F.col("c_custkey"))).select(
        F.col("c_name").alias("ID"),
        F.col("birthdate").cast("string").alias("BIRTHDATE"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "M").otherwise("F").alias("GENDER"),
        F.col("c_nationkey").cast("string").alias("STATE"),
        _money(F.col("c_acctbal")).alias("HEALTHCARE_EXPENSES"),
        _money(F.col("c_acctbal")).alias("INCOME"),
    )
    s = t.raw("supplier")
    n = F.broadcast(t.raw("nation"))  # fixed 25 rows
    provs = s.join(n, s.s_nationkey == n.n_nationkey, "left").select(
        F.col("s_name").alias("Id"),
        F.col("s_name").alias("NAME"),
        F.lit("GENERAL PRACTICE").alias("SPECIALITY"),
        F.col("n_name").alias("STATE"),
    )
    enc = t.encounters_with_stop().select(
        F.col("encounter_key").cast("string").alias("Id"),
        F.concat(F.col("start_date").cast("string"), F.lit("T00:00:00Z")).alias("START"),
        F.concat(F.col("stop_date").cast("string"), F.lit("T23:59:00Z")).alias("STOP"),
        _natural_id("Customer#", F.col("patient_key")).alias("PATIENT"),
        _natural_id("Supplier#", F.col("provider_key")).alias("PROVIDER"),
        F.col("encounter_class").alias("ENCOUNTERCLASS"),
        _money(F.col("total_claim_cost")).alias("BASE_ENCOUNTER_COST"),
        _money(F.col("total_claim_cost")).alias("TOTAL_CLAIM_COST"),
    )
    li = t.raw("lineitem")
    o = t.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lo = li.join(o, "l_orderkey")
    p = t.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_name")
    ship = F.col("l_shipdate").cast("date")
    conds = lo.join(p, "l_partkey").select(
        ship.cast("string").alias("START"),
        F.when(F.col("l_linestatus") == DRIVER_ACTIVE_STATUS, F.lit("")).otherwise(
            ship.cast("string")
        ).alias("STOP"),
        _natural_id("Customer#", F.col("o_custkey")).alias("PATIENT"),
        F.col("l_orderkey").cast("string").alias("ENCOUNTER"),
        F.col("p_brand").alias("CODE"),
        F.col("p_name").alias("DESCRIPTION"),
    )
    meds = lo.select(
        ship.cast("string").alias("START"),
        F.date_add(ship, F.col("l_quantity").cast("int")).cast("string").alias("STOP"),
        _natural_id("Customer#", F.col("o_custkey")).alias("PATIENT"),
        F.col("l_orderkey").cast("string").alias("ENCOUNTER"),
        F.col("l_partkey").cast("string").alias("CODE"),
        _money(F.col("l_extendedprice")).alias("BASE_COST"),
        F.col("l_quantity").cast("string").alias("DISPENSES"),
        _money(F.col("l_extendedprice")).alias("TOTALCOST"),
    )
    return {
        "raw_patients": _complete(pats, "raw_patients", "customer.parquet"),
        "raw_providers": _complete(provs, "raw_providers", "supplier.parquet"),
        "raw_encounters": _complete(enc, "raw_encounters", "orders.parquet"),
        "raw_conditions": _complete(conds, "raw_conditions", "lineitem.parquet"),
        "raw_medications": _complete(meds, "raw_medications", "lineitem.parquet"),
    }


def _sql_id(prefix: str, key: str) -> str:
    return f"'{prefix}' || repeat('0', greatest({ID_WIDTH} - length(CAST({key} AS VARCHAR)), 0)) || CAST({key} AS VARCHAR)"


def _sql_money(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(12,2)) AS VARCHAR)"


# DuckDB rendering (needs the ``patient`` and ``encounter`` binding views).
RAW_SQL: dict[str, str] = {
    "raw_patients": f"""SELECT c.c_name AS "ID", CAST(p.birthdate AS VARCHAR) AS "BIRTHDATE",
        CASE WHEN c.c_mktsegment = 'MACHINERY' THEN 'M' ELSE 'F' END AS "GENDER",
        CAST(c.c_nationkey AS VARCHAR) AS "STATE",
        {_sql_money('c.c_acctbal')} AS "HEALTHCARE_EXPENSES", {_sql_money('c.c_acctbal')} AS "INCOME"
      FROM customer c JOIN patient p ON p.patient_key = c.c_custkey""",
    "raw_providers": """SELECT s_name AS "Id", s_name AS "NAME", 'GENERAL PRACTICE' AS "SPECIALITY",
        n_name AS "STATE" FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "raw_encounters": f"""SELECT CAST(encounter_key AS VARCHAR) AS "Id",
        CAST(start_date AS VARCHAR) || 'T00:00:00Z' AS "START",
        CAST(stop_date AS VARCHAR) || 'T23:59:00Z' AS "STOP",
        {_sql_id('Customer#', 'patient_key')} AS "PATIENT",
        {_sql_id('Supplier#', 'provider_key')} AS "PROVIDER",
        encounter_class AS "ENCOUNTERCLASS",
        {_sql_money('total_claim_cost')} AS "BASE_ENCOUNTER_COST",
        {_sql_money('total_claim_cost')} AS "TOTAL_CLAIM_COST",
        CAST(NULL AS VARCHAR) AS "DESCRIPTION", CAST(NULL AS VARCHAR) AS "PAYER_COVERAGE",
        CAST(NULL AS VARCHAR) AS "REASONCODE", CAST(NULL AS VARCHAR) AS "REASONDESCRIPTION"
      FROM encounter""",
    "raw_conditions": f"""SELECT CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) AS "START",
        CASE WHEN l.l_linestatus = '{DRIVER_ACTIVE_STATUS}' THEN '' ELSE CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) END AS "STOP",
        {_sql_id('Customer#', 'o.o_custkey')} AS "PATIENT", CAST(l.l_orderkey AS VARCHAR) AS "ENCOUNTER",
        p.p_brand AS "CODE", p.p_name AS "DESCRIPTION"
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey""",
    "raw_medications": f"""SELECT CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) AS "START",
        CAST(CAST(l.l_shipdate AS DATE) + CAST(l.l_quantity AS INTEGER) AS VARCHAR) AS "STOP",
        {_sql_id('Customer#', 'o.o_custkey')} AS "PATIENT", CAST(l.l_orderkey AS VARCHAR) AS "ENCOUNTER",
        CAST(l.l_partkey AS VARCHAR) AS "CODE", CAST(NULL AS VARCHAR) AS "DESCRIPTION",
        {_sql_money('l.l_extendedprice')} AS "BASE_COST", CAST(l.l_quantity AS VARCHAR) AS "DISPENSES",
        {_sql_money('l.l_extendedprice')} AS "TOTALCOST", CAST(NULL AS VARCHAR) AS "PAYER_COVERAGE"
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""",
}


def _day(col: str) -> str:
    """The day number YYYYMMDD that an ISO text begins with; the rendering above writes no other dates."""
    return f"CAST(nullif(replace(left({col}, 10), '-', ''), '') AS INTEGER)"


def _number(order: str) -> str:
    return f"row_number() OVER (ORDER BY {order})"


def _find(key: str, table: str, col: str, value: str) -> str:
    """The surrogate key of a natural one, NULL where there is none."""
    return f"(SELECT d.{key} FROM {table} d WHERE d.{col} = {value})"


def _amount(col: str, digits: int) -> str:
    return f"CAST({col} AS DECIMAL({digits},2))"


def _episodes(raw: str, *cols: str) -> str:
    """The raw rows of a table of episodes with their patient, encounter and days."""
    return f"""SELECT {_find('patient_key', 'dim_patient', 'patient_id', 'x."PATIENT"')} AS patient_key,
        {_find('encounter_key', 'fact_encounter', 'encounter_id', 'x."ENCOUNTER"')} AS encounter_key,
        {_day('x."START"')} AS start_date_key, {_day('x."STOP"')} AS stop_date_key, {', '.join(cols)} FROM {raw} x"""


# The star over the raw rendering, worked out from what the tables mean: a first
# load, so keys count up in natural-key order.
STAR_SQL: dict[str, str] = {
    "dim_patient": f"""SELECT "ID" AS patient_id, {_number('"ID"')} AS patient_key,
        CAST("BIRTHDATE" AS DATE) AS birthdate, NULL::DATE AS deathdate, "GENDER" AS gender, "STATE" AS state,
        {_amount('"HEALTHCARE_EXPENSES"', 12)} AS healthcare_expenses, CAST("INCOME" AS INTEGER) AS income
      FROM raw_patients""",
    "dim_provider": f"""SELECT "Id" AS provider_id, {_number('"Id"')} AS provider_key, "NAME" AS name,
        "SPECIALITY" AS speciality, "STATE" AS state FROM raw_providers""",
    "fact_encounter": f"""SELECT "Id" AS encounter_id, {_number('"Id"')} AS encounter_key,
        {_find('patient_key', 'dim_patient', 'patient_id', '"PATIENT"')} AS patient_key,
        {_find('provider_key', 'dim_provider', 'provider_id', '"PROVIDER"')} AS provider_key,
        {_day('"START"')} AS start_date_key, {_day('"STOP"')} AS stop_date_key, "ENCOUNTERCLASS" AS encounter_class,
        {_amount('"BASE_ENCOUNTER_COST"', 10)} AS base_cost, {_amount('"TOTAL_CLAIM_COST"', 10)} AS total_claim_cost
      FROM raw_encounters""",
    "fact_condition": f"""SELECT {_number('patient_key NULLS FIRST, snomed_code NULLS FIRST, start_date_key NULLS FIRST, encounter_key NULLS FIRST, stop_date_key NULLS FIRST, description NULLS FIRST')} AS condition_key, *
      FROM ({_episodes('raw_conditions', 'x."CODE" AS snomed_code', 'x."DESCRIPTION" AS description', 'x."PATIENT" AS patient_id')})""",
    "fact_medication": _episodes(
        "raw_medications", "nullif(x.\"CODE\", '') AS rxnorm_code", f"{_amount('x.\"BASE_COST\"', 10)} AS base_cost",
        f"{_amount('x.\"TOTALCOST\"', 10)} AS total_cost", "TRY_CAST(x.\"DISPENSES\" AS INTEGER) AS dispenses"),
    "dim_condition_code": f"""SELECT {_number('snomed_code')} AS code_key, snomed_code, description FROM (
        SELECT "CODE" AS snomed_code, min("DESCRIPTION") AS description FROM raw_conditions
        WHERE coalesce("CODE", '') <> '' GROUP BY "CODE")""",
}

_ORDER = ["raw_patients", "raw_providers", "raw_encounters", "raw_conditions", "raw_medications",
          "dim_patient", "dim_provider", "dim_condition_code", "fact_encounter", "fact_condition",
          "fact_medication"]


def star_sql_ctes(needed: list[str]) -> list[tuple[str, str]]:
    """(name, sql) pairs for the raw/star views ``needed`` and their inputs."""
    deps = {
        "dim_patient": ["raw_patients"],
        "dim_provider": ["raw_providers"],
        "dim_condition_code": ["raw_conditions"],
        "fact_encounter": ["raw_encounters", "dim_patient", "dim_provider"],
        "fact_condition": ["raw_conditions", "dim_patient", "fact_encounter"],
        "fact_medication": ["raw_medications", "dim_patient", "fact_encounter"],
    }
    want: set[str] = set()

    def add(n):
        if n in want:
            return
        want.add(n)
        for d in deps.get(n, []):
            add(d)

    for n in needed:
        add(n)
    allsql = {**RAW_SQL, **STAR_SQL}
    return [(n, allsql[n]) for n in _ORDER if n in want]
