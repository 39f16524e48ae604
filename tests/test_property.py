"""Random data with orphans (NULL keys), ties, open stays and out-of-calendar
dates: Spark marts against independent DuckDB SQL."""

import datetime as dt
import random
from decimal import Decimal

import duckdb
import pandas as pd
import pytest

from pyspark.sql import functions as F

from carespark.plans import analytics as A

CAL = ("2000-01-01", "2030-12-31")


def _data(seed, n=400):
    rnd = random.Random(seed)
    rows = []
    for k in range(1, n + 1):
        p = None if rnd.random() < 0.1 else (1 if rnd.random() < 0.3 else rnd.randint(2, 30))
        start = dt.date(1999, 6, 1) + dt.timedelta(days=rnd.randint(0, 1500))
        stop = None if rnd.random() < 0.1 else start + dt.timedelta(days=rnd.randint(0, 5))
        cls = rnd.choice(["inpatient", "inpatient", "ambulatory", "emergency"])
        cost = None if rnd.random() < 0.05 else Decimal(rnd.randint(100, 99999)) / 100
        rows.append((k, p, start, stop, cls, cost))
    return rows


SCHEMA = ("encounter_key long, patient_key long, start_date date, stop_date date, "
          "encounter_class string, total_claim_cost decimal(10,2)")


@pytest.fixture(scope="module", params=[1, 2, 3])
def case(request, spark):
    rows = _data(request.param)
    df = spark.createDataFrame(rows, SCHEMA)
    pdf = pd.DataFrame(rows, columns=["encounter_key", "patient_key", "start_date", "stop_date",
                                      "encounter_class", "total_claim_cost"])
    con = duckdb.connect()
    con.register("e_raw", pdf)
    con.execute("""CREATE VIEW e AS SELECT encounter_key, CAST(patient_key AS BIGINT) AS patient_key,
        CAST(start_date AS DATE) AS start_date, CAST(stop_date AS DATE) AS stop_date, encounter_class,
        CAST(total_claim_cost AS DECIMAL(10,2)) AS total_claim_cost FROM e_raw""")
    return df, con


def _in(c):
    return f"{c} BETWEEN DATE '{CAL[0]}' AND DATE '{CAL[1]}'"


def test_readmission_random(case):
    df, con = case
    got = sorted(tuple(r) for r in A.readmission_rate(df, calendar=CAL).collect())
    exp = sorted(con.execute(f"""
      WITH i AS (SELECT * FROM e WHERE encounter_class = 'inpatient' AND {_in('start_date')} AND {_in('stop_date')}),
      w AS (SELECT *, LAG(stop_date) OVER (PARTITION BY patient_key ORDER BY start_date, encounter_key) AS prior FROM i)
      SELECT CAST(year(start_date) AS INTEGER), COUNT(*),
        COUNT(*) FILTER (WHERE prior IS NOT NULL AND start_date - prior <= 30),
        ROUND(100.0 * COUNT(*) FILTER (WHERE prior IS NOT NULL AND start_date - prior <= 30) / COUNT(*), 2)
      FROM w GROUP BY 1""").fetchall())
    assert [g[:3] for g in got] == [e[:3] for e in exp]
    assert all(abs(g[3] - float(e[3])) < 1e-9 for g, e in zip(got, exp))


def test_cost_and_utilization_random(case):
    df, con = case
    got = sorted(tuple(r) for r in A.cost_benchmarking(df, calendar=CAL).collect())
    exp = sorted(con.execute(f"""
      WITH c AS (SELECT CAST(year(start_date) AS INTEGER) AS y, patient_key, total_claim_cost AS v FROM e
                 WHERE {_in('start_date')} AND total_claim_cost IS NOT NULL),
      r AS (SELECT *, NTILE(4) OVER (PARTITION BY y ORDER BY v, patient_key) AS q FROM c)
      SELECT y, COUNT(DISTINCT patient_key), ROUND(AVG(v), 2),
        ROUND(PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY CAST(v AS DOUBLE)), 2),
        ROUND(PERCENTILE_CONT(0.9) WITHIN GROUP (ORDER BY CAST(v AS DOUBLE)), 2),
        ROUND(PERCENTILE_CONT(0.99) WITHIN GROUP (ORDER BY CAST(v AS DOUBLE)), 2),
        CAST(MAX(v) AS DOUBLE), COUNT(*) FILTER (WHERE q = 4)
      FROM r GROUP BY y""").fetchall())
    assert len(got) == len(exp)
    for g, e in zip(got, exp):
        assert g[0] == e[0] and g[1] == e[1] and g[7] == e[7]
        assert all(abs(a - float(b)) < 0.011 for a, b in zip(g[2:7], e[2:7]))
    got_u = sorted(tuple(r) for r in A.utilization_trends(df, calendar=CAL).collect())
    exp_u = sorted(con.execute(f"""
      WITH y AS (SELECT CAST(year(start_date) AS INTEGER) AS yr, encounter_class AS c, COUNT(*) AS n,
                 ROUND(SUM(total_claim_cost), 2) AS t FROM e WHERE {_in('start_date')} GROUP BY 1, 2)
      SELECT yr, c, n, CAST(t AS DOUBLE), n - LAG(n) OVER w,
        ROUND(100.0 * (n - LAG(n) OVER w) / NULLIF(LAG(n) OVER w, 0), 2),
        CAST(t - LAG(t) OVER w AS DOUBLE),
        ROUND(100.0 * CAST(t - LAG(t) OVER w AS DOUBLE) / CAST(NULLIF(LAG(t) OVER w, 0) AS DOUBLE), 2)
      FROM y WINDOW w AS (PARTITION BY c ORDER BY yr)""").fetchall())
    norm = lambda r: tuple(None if v is None else (float(v) if not isinstance(v, str) else v) for v in r)
    assert [norm(r) for r in got_u] == [norm(r) for r in exp_u]


CODES = ["44054006", "73211009", "84114007", "13645005", "195967001", "59621000", "1111", "2222"]
SETS = {"diabetes": ["44054006", "73211009"], "heart_failure": ["84114007"],
        "copd_asthma": ["13645005", "195967001"], "hypertension": ["59621000"]}


def _conditions(seed, n=300):
    rnd = random.Random(seed + 100)
    out = []
    for _ in range(n):
        p = None if rnd.random() < 0.05 else rnd.randint(1, 35)
        start = dt.date(2000, 1, 1) + dt.timedelta(days=rnd.randint(0, 800))
        stop = None if rnd.random() < 0.5 else start + dt.timedelta(days=rnd.randint(0, 90))
        out.append((p, rnd.choice(CODES), start, stop))
    return out


@pytest.fixture(scope="module", params=[4, 5])
def case_c(request, spark):
    e_rows = _data(request.param)
    c_rows = _conditions(request.param)
    e = spark.createDataFrame(e_rows, SCHEMA)
    c = spark.createDataFrame(c_rows, "patient_key long, code string, start_date date, stop_date date")
    con = duckdb.connect()
    con.register("e_raw", pd.DataFrame(e_rows, columns=["encounter_key", "patient_key", "start_date", "stop_date",
                                                         "encounter_class", "total_claim_cost"]))
    con.register("c_raw", pd.DataFrame(c_rows, columns=["patient_key", "code", "start_date", "stop_date"]))
    con.execute("""CREATE VIEW e AS SELECT encounter_key, CAST(patient_key AS BIGINT) AS patient_key,
        CAST(start_date AS DATE) AS start_date, encounter_class FROM e_raw""")
    con.execute("""CREATE VIEW c AS SELECT CAST(patient_key AS BIGINT) AS patient_key, code,
        CAST(stop_date AS DATE) AS stop_date FROM c_raw""")
    return e, c, con


def _list(v):
    return ", ".join(f"'{x}'" for x in v)


def test_cohorts_random(case_c):
    e, c, con = case_c
    got = sorted(tuple(r) for r in A.cohort_segmentation(e, c, condition_sets=SETS, calendar=CAL).collect())
    exp = sorted(con.execute(f"""
      WITH pc AS (SELECT patient_key, COUNT(DISTINCT code) AS n,
          MAX(CASE WHEN code IN ({_list(SETS['diabetes'])}) THEN 1 ELSE 0 END) AS d,
          MAX(CASE WHEN code IN ({_list(SETS['heart_failure'])}) THEN 1 ELSE 0 END) AS h,
          MAX(CASE WHEN code IN ({_list(SETS['copd_asthma'])}) THEN 1 ELSE 0 END) AS co,
          MAX(CASE WHEN code IN ({_list(SETS['hypertension'])}) THEN 1 ELSE 0 END) AS hy
        FROM c GROUP BY patient_key),
      py AS (SELECT patient_key, CAST(year(MIN(start_date)) AS INTEGER) AS y FROM e WHERE {_in('start_date')} GROUP BY patient_key)
      SELECT py.y, COUNT(*), SUM(COALESCE(d, 0)), SUM(COALESCE(h, 0)), SUM(COALESCE(co, 0)), SUM(COALESCE(hy, 0)),
        ROUND(AVG(CAST(COALESCE(n, 0) AS DOUBLE)), 2)
      FROM py LEFT JOIN pc ON pc.patient_key = py.patient_key GROUP BY py.y""").fetchall())
    assert [tuple(int(x) if i < 6 else float(x) for i, x in enumerate(r)) for r in got] == \
        [tuple(int(x) if i < 6 else float(x) for i, x in enumerate(r)) for r in exp]


@pytest.mark.parametrize("as_of", ["2002-06-30", "2003-12-31"])
def test_care_gap_random(case_c, as_of):
    e, c, con = case_c
    got = [tuple(r) for r in A.care_gap_rate(e, c, code_set=SETS["diabetes"], as_of=as_of, calendar=CAL).collect()]
    exp = con.execute(f"""
      WITH dp AS (SELECT DISTINCT patient_key FROM c WHERE code IN ({_list(SETS['diabetes'])}) AND stop_date IS NULL),
      le AS (SELECT patient_key, MAX(start_date) AS last FROM e WHERE {_in('start_date')} GROUP BY patient_key)
      SELECT COUNT(*), COUNT(*) FILTER (WHERE le.last IS NULL OR DATE '{as_of}' - le.last > 365)
      FROM dp LEFT JOIN le ON le.patient_key = dp.patient_key""").fetchall()
    assert got[0][:2] == exp[0]


DATES = ["2022-01-10", "2022-01-10T09:00:00Z", "2022-1-5", "2022-02-30", "2022", "2022-01", "",
         "junk", "2022/01/05", "1999-12-31 23:59", "2024-02-29", "2023-02-29"]
MONEY = ["123.45", "12.345", "abc", "", "99999999.99", "123456789.12", "-5", "0.005", " 7 "]
INTS = ["12.7", "-12.5", "1e3", "x", "", "2147483647", "2147483648", "55000", "3."]


@pytest.mark.parametrize("seed", [11, 12])
def test_star_parsing_of_dirty_text_matches_reference_casts(spark, seed):
    from carespark.plans.star import typed_encounters, typed_patients

    rnd = random.Random(seed)
    enc = [(f"E{i}", rnd.choice(DATES), rnd.choice(DATES), rnd.choice(MONEY)) for i in range(300)]
    pats = [(f"P{i}", rnd.choice(INTS), rnd.choice(MONEY), rnd.choice(DATES)) for i in range(200)]
    e = spark.createDataFrame(enc, "Id string, START string, STOP string, TOTAL_CLAIM_COST string")
    for c in ["PATIENT", "PROVIDER", "ENCOUNTERCLASS", "DESCRIPTION", "BASE_ENCOUNTER_COST",
              "PAYER_COVERAGE", "REASONCODE", "REASONDESCRIPTION"]:
        e = e.withColumn(c, F.lit(None).cast("string"))
    dims = spark.createDataFrame([], "patient_id string, patient_key long")
    provs = spark.createDataFrame([], "provider_id string, provider_key long")
    got = {r.encounter_id: (r.start_date_key, r.stop_date_key,
                            None if r.total_claim_cost is None else str(r.total_claim_cost))
           for r in typed_encounters(e, dims, provs).collect()}
    p = spark.createDataFrame(pats, "ID string, INCOME string, HEALTHCARE_EXPENSES string, BIRTHDATE string")
    for c in ["DEATHDATE", "GENDER", "RACE", "ETHNICITY", "CITY", "STATE", "ZIP", "HEALTHCARE_COVERAGE"]:
        p = p.withColumn(c, F.lit(None).cast("string"))
    got_p = {r.patient_id: (r.income, None if r.healthcare_expenses is None else str(r.healthcare_expenses),
                            r.birthdate) for r in typed_patients(p).collect()}
    con = duckdb.connect()
    con.register("e", pd.DataFrame(enc, columns=["Id", "START", "STOP", "COST"]))
    con.register("p", pd.DataFrame(pats, columns=["ID", "INCOME", "EXP", "BIRTH"]))
    dk = "CAST(strftime(TRY_CAST(substr({0}, 1, 10) AS DATE), '%Y%m%d') AS INTEGER)"
    exp = {r[0]: (r[1], r[2], None if r[3] is None else str(r[3])) for r in con.execute(
        f"SELECT Id, {dk.format('START')}, {dk.format('STOP')}, TRY_CAST(COST AS DECIMAL(10,2)) FROM e").fetchall()}
    exp_p = {r[0]: (r[1], None if r[2] is None else str(r[2]), r[3]) for r in con.execute(
        "SELECT ID, TRY_CAST(INCOME AS INTEGER), TRY_CAST(EXP AS DECIMAL(12,2)), "
        "TRY_CAST(substr(BIRTH, 1, 10) AS DATE) FROM p").fetchall()}
    assert got == exp
    assert got_p == exp_p
