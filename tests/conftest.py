from __future__ import annotations

import csv
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from carespark.sources.contracts import CONTRACTS  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from carespark.session import get_session

    s = get_session("local[4]", app_name="carespark-tests", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()


def write_csv(directory, fname: str, rows: list[dict], cols: list[str] | None = None) -> str:
    """Write a contract CSV (header + rows); missing fields are empty."""
    table = next(t for t, (f, _) in CONTRACTS.items() if f == fname)
    cols = cols or CONTRACTS[table][1]
    path = os.path.join(str(directory), fname)
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(cols)
        for r in rows:
            w.writerow([r.get(c, "") for c in cols])
    return path


PID1 = "aaaaaaaa-0001-0001-0001-000000000001"
EID1 = "bbbbbbbb-0001-0001-0001-000000000001"

BASE = {
    "patients.csv": [{
        "ID": PID1, "BIRTHDATE": "1960-03-15", "DEATHDATE": "", "GENDER": "F", "RACE": "white",
        "ETHNICITY": "nonhispanic", "CITY": "Springfield", "STATE": "MA", "ZIP": "01101",
        "HEALTHCARE_EXPENSES": "45000.00", "HEALTHCARE_COVERAGE": "38000.00", "INCOME": "55000",
    }],
    "encounters.csv": [{
        "Id": EID1, "START": "2022-01-10T09:00:00Z", "STOP": "2022-01-12T11:00:00Z", "PATIENT": PID1,
        "PROVIDER": "prov-001", "ENCOUNTERCLASS": "inpatient", "BASE_ENCOUNTER_COST": "5000.00",
        "TOTAL_CLAIM_COST": "7500.00", "PAYER_COVERAGE": "6000.00", "REASONCODE": "",
    }],
    "conditions.csv": [{
        "START": "2018-06-01", "STOP": "", "PATIENT": PID1, "ENCOUNTER": EID1, "CODE": "44054006",
        "DESCRIPTION": "Diabetes mellitus type 2",
    }],
    "medications.csv": [{
        "START": "2022-01-10", "STOP": "2022-04-10", "PATIENT": PID1, "ENCOUNTER": EID1,
        "CODE": "860975", "DESCRIPTION": "metformin", "BASE_COST": "5.00", "PAYER_COVERAGE": "4.00",
        "DISPENSES": "3", "TOTALCOST": "15.00",
    }],
    "providers.csv": [{
        "Id": "prov-001", "NAME": "Dr One", "SPECIALITY": "GENERAL PRACTICE", "CITY": "Springfield",
        "STATE": "MA", "ZIP": "01101",
    }],
}


def _enc(i, p, cls, start, stop, cost):
    return {"Id": i, "START": start + "T08:00:00Z", "STOP": stop + "T10:00:00Z", "PATIENT": p,
            "PROVIDER": "prov-001", "ENCOUNTERCLASS": cls, "TOTAL_CLAIM_COST": cost,
            "BASE_ENCOUNTER_COST": cost}


GOLDEN = {
    "patients.csv": [
        {"ID": "P1", "BIRTHDATE": "1950-01-01", "GENDER": "M", "HEALTHCARE_EXPENSES": "1000.00"},
        {"ID": "P2", "BIRTHDATE": "1970-06-30", "GENDER": "F", "HEALTHCARE_EXPENSES": "3000.00"},
        {"ID": "P3", "BIRTHDATE": "1980-12-31", "GENDER": "F", "HEALTHCARE_EXPENSES": "2000.00"},
    ],
    "encounters.csv": [
        _enc("E1", "P1", "inpatient", "2022-01-10", "2022-01-12", "7500.00"),
        _enc("E2", "P1", "inpatient", "2022-02-11", "2022-02-13", "100.00"),
        _enc("E3", "P1", "inpatient", "2022-03-16", "2022-03-16", ""),
        _enc("E4", "P2", "ambulatory", "2021-05-01", "2021-05-01", "50.00"),
        _enc("E5", "P2", "inpatient", "2022-12-30", "2023-01-02", "200.00"),
        _enc("E6", "P2", "inpatient", "2023-01-02", "2023-01-05", "300.00"),
    ],
    "conditions.csv": [
        {"START": "2021-01-01", "STOP": "", "PATIENT": "P1", "ENCOUNTER": "E1", "CODE": "44054006",
         "DESCRIPTION": "Diabetes mellitus type 2"},
        {"START": "2021-01-01", "STOP": "2021-06-01", "PATIENT": "P1", "ENCOUNTER": "E1",
         "CODE": "59621000", "DESCRIPTION": "Essential hypertension"},
        {"START": "2021-02-01", "STOP": "", "PATIENT": "P2", "ENCOUNTER": "E4", "CODE": "84114007",
         "DESCRIPTION": "Heart failure"},
        {"START": "2021-03-01", "STOP": "", "PATIENT": "P3", "ENCOUNTER": "", "CODE": "73211009",
         "DESCRIPTION": "Diabetes mellitus"},
    ],
    "medications.csv": [],
    "providers.csv": BASE["providers.csv"],
}


def write_fixture(directory, spec: dict[str, list[dict]]) -> str:
    os.makedirs(str(directory), exist_ok=True)
    for fname, rows in spec.items():
        write_csv(directory, fname, rows)
    return str(directory)


@pytest.fixture(scope="session")
def base_dir(tmp_path_factory):
    return write_fixture(tmp_path_factory.mktemp("base"), BASE)


@pytest.fixture(scope="session")
def golden_dir(tmp_path_factory):
    return write_fixture(tmp_path_factory.mktemp("golden"), GOLDEN)


def load_and_build(spark, data_dir, tmp, **kw):
    from carespark.plans.star import build_star
    from carespark.sources.csv_ingest import load_raw

    res = load_raw(spark, data_dir, str(tmp))
    return res, build_star(spark, res.tables, **kw)


@pytest.fixture(scope="session")
def base_star(spark, base_dir, tmp_path_factory):
    return load_and_build(spark, base_dir, tmp_path_factory.mktemp("base_raw"))


@pytest.fixture(scope="session")
def golden_star(spark, golden_dir, tmp_path_factory):
    return load_and_build(spark, golden_dir, tmp_path_factory.mktemp("golden_raw"))
