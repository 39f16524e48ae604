"""Raw source contracts (SRC-02): file name -> raw table -> exact column list.

FIXED VALUES: the CSV header names of the five clinical extracts, in file
order. Raw tables hold every column as text plus ``_source_file``.
Contracts are versioned: a new version may only add nullable columns
(schema evolution rule), never rename or drop.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- FIXED VALUES: CSV headers (version 1) ----------------------------
PATIENT_COLS = [
    "ID", "BIRTHDATE", "DEATHDATE", "SSN", "DRIVERS", "PASSPORT", "PREFIX", "FIRST", "LAST",
    "SUFFIX", "MAIDEN", "MARITAL", "RACE", "ETHNICITY", "GENDER", "BIRTHPLACE", "ADDRESS",
    "CITY", "STATE", "COUNTY", "FIPS", "ZIP", "LAT", "LON", "HEALTHCARE_EXPENSES",
    "HEALTHCARE_COVERAGE", "INCOME",
]
ENCOUNTER_COLS = [
    "Id", "START", "STOP", "PATIENT", "ORGANIZATION", "PROVIDER", "PAYER", "ENCOUNTERCLASS",
    "CODE", "DESCRIPTION", "BASE_ENCOUNTER_COST", "TOTAL_CLAIM_COST", "PAYER_COVERAGE",
    "REASONCODE", "REASONDESCRIPTION",
]
CONDITION_COLS = ["START", "STOP", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION"]
MEDICATION_COLS = [
    "START", "STOP", "PATIENT", "PAYER", "ENCOUNTER", "CODE", "DESCRIPTION", "BASE_COST",
    "PAYER_COVERAGE", "DISPENSES", "TOTALCOST", "REASONCODE", "REASONDESCRIPTION",
]
PROVIDER_COLS = [
    "Id", "ORGANIZATION", "NAME", "GENDER", "SPECIALITY", "ADDRESS", "CITY", "STATE", "ZIP",
    "LAT", "LON", "ENCOUNTERS", "PROCEDURES",
]

# raw table -> (file name, columns)
CONTRACTS: dict[str, tuple[str, list[str]]] = {
    "raw_patients": ("patients.csv", PATIENT_COLS),
    "raw_encounters": ("encounters.csv", ENCOUNTER_COLS),
    "raw_conditions": ("conditions.csv", CONDITION_COLS),
    "raw_medications": ("medications.csv", MEDICATION_COLS),
    "raw_providers": ("providers.csv", PROVIDER_COLS),
}
CONTRACT_VERSION = 1
SOURCE_FILE_COL = "_source_file"

# Versioned registry: version -> {table: columns}. Later versions may only
# append nullable columns.
CONTRACT_VERSIONS: dict[int, dict[str, list[str]]] = {
    1: {t: cols for t, (_, cols) in CONTRACTS.items()},
}


def raw_schema(table: str, version: int = CONTRACT_VERSION) -> T.StructType:
    """All-string raw schema of ``table`` plus the lineage column."""
    cols = CONTRACT_VERSIONS[version][table]
    return T.StructType(
        [T.StructField(c, T.StringType(), True) for c in cols]
        + [T.StructField(SOURCE_FILE_COL, T.StringType(), True)]
    )


def check_evolution(old: list[str], new: list[str]) -> None:
    """Allow only appended columns between contract versions."""
    if new[: len(old)] != old:
        raise ValueError("contract change must only append columns")


# ---- typed star schema (SRC-10) --------------------------------------------
def _s(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


STR, INT, LONG, DATE, SHORT = T.StringType(), T.IntegerType(), T.LongType(), T.DateType(), T.ShortType()
D10, D12 = T.DecimalType(10, 2), T.DecimalType(12, 2)

# FIXED VALUES: names, order and types of the star's columns. The condition and
# medication facts end in the patient's id as the raw text has it, which tells
# rows of unknown patients apart.
STAR_SCHEMAS: dict[str, T.StructType] = {
    "dim_date": _s(("date_key", INT, False), ("full_date", DATE, False), ("year", SHORT, False),
                   ("month", SHORT, False), ("day", SHORT, False), ("quarter", SHORT, False),
                   ("day_of_week", SHORT, False)),
    "dim_patient": _s(("patient_key", LONG, False), ("patient_id", STR, False),
                      ("birthdate", DATE, True), ("deathdate", DATE, True), ("gender", STR, True),
                      ("race", STR, True), ("ethnicity", STR, True), ("city", STR, True),
                      ("state", STR, True), ("zip", STR, True),
                      ("healthcare_expenses", D12, True), ("healthcare_coverage", D12, True),
                      ("income", INT, True)),
    "dim_provider": _s(("provider_key", LONG, False), ("provider_id", STR, False),
                       ("name", STR, True), ("speciality", STR, True), ("city", STR, True),
                       ("state", STR, True)),
    "dim_condition_code": _s(("code_key", LONG, False), ("snomed_code", STR, False),
                             ("description", STR, True)),
    "fact_encounter": _s(("encounter_key", LONG, False), ("patient_key", LONG, True),
                         ("provider_key", LONG, True), ("start_date_key", INT, True),
                         ("stop_date_key", INT, True), ("encounter_id", STR, False),
                         ("encounter_class", STR, True), ("description", STR, True),
                         ("base_cost", D10, True), ("total_claim_cost", D10, True),
                         ("payer_coverage", D10, True), ("reason_code", STR, True),
                         ("reason_description", STR, True)),
    "fact_condition": _s(("condition_key", LONG, False), ("patient_key", LONG, True),
                         ("encounter_key", LONG, True), ("start_date_key", INT, True),
                         ("stop_date_key", INT, True), ("snomed_code", STR, True),
                         ("description", STR, True), ("patient_id", STR, True)),
    "fact_medication": _s(("medication_key", LONG, False), ("patient_key", LONG, True),
                          ("encounter_key", LONG, True), ("start_date_key", INT, True),
                          ("stop_date_key", INT, True), ("rxnorm_code", STR, True),
                          ("description", STR, True), ("base_cost", D10, True),
                          ("total_cost", D10, True), ("dispenses", INT, True),
                          ("payer_coverage", D10, True), ("patient_id", STR, True)),
}
