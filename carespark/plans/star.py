"""Raw text tables -> typed star schema (STR-01..09, JOI-03/06/07, WIN-04).

``build_star(raw, existing)`` is a plain function of DataFrames. Per table:
parse/try-cast the text, look up surrogate keys of the dimensions with left
joins (orphans keep a NULL key), keep only rows whose natural key is not yet
stored (anti-join on the natural key), number the new rows after the current maximum
key (distributed rank), and check the calendar foreign keys — violators are
quarantined instead of aborting the whole load as the reference engine does.

The result holds, per table, the new rows and the refreshed full table
(existing ∪ new) as lazy DataFrames; writing them is the caller's choice
(see :mod:`carespark.plans.marts` for staged, atomic writes).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carespark import codes
from carespark.functions import columns as C
from carespark.operators.calendar import calendar_dim, small_enough
from carespark.operators.keys import assign_surrogate_keys, insert_if_absent, max_key, split_duplicates
from carespark.operators.quality import ConstraintViolation, check_not_null, check_unique
from carespark.session import stable_table
from carespark.sources.contracts import STAR_SCHEMAS


def schema_conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """SRC-10: ordered select + cast to ``schema``; missing columns become NULL."""
    have = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        col = F.col(src).cast(f.dataType) if src else F.lit(None).cast(f.dataType)
        cols.append(col.alias(f.name))
    return df.select(*cols)


def _union(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    return new if existing is None else existing.unionByName(new)


@dataclass
class StarBuild:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    appended: dict[str, DataFrame] = field(default_factory=dict)
    quarantined: dict[str, DataFrame] = field(default_factory=dict)
    rejected: dict[str, DataFrame] = field(default_factory=dict)  # rows without the natural key that their table needs
    duplicates: dict[str, DataFrame] = field(default_factory=dict)  # rows a de-duplication removed, with a count


# -- typed projections of the raw contracts ----------------------------------
def typed_patients(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("ID").alias("patient_id"),
        C.iso_prefix_to_date("BIRTHDATE").alias("birthdate"),
        C.iso_prefix_to_date("DEATHDATE").alias("deathdate"),
        F.col("GENDER").alias("gender"),
        F.col("RACE").alias("race"),
        F.col("ETHNICITY").alias("ethnicity"),
        F.col("CITY").alias("city"),
        F.col("STATE").alias("state"),
        F.col("ZIP").alias("zip"),
        C.try_decimal("HEALTHCARE_EXPENSES", 12, 2).alias("healthcare_expenses"),
        C.try_decimal("HEALTHCARE_COVERAGE", 12, 2).alias("healthcare_coverage"),
        C.try_integer("INCOME").alias("income"),
    )


def typed_providers(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("Id").alias("provider_id"),
        F.col("NAME").alias("name"),
        F.col("SPECIALITY").alias("speciality"),
        F.col("CITY").alias("city"),
        F.col("STATE").alias("state"),
    )


def code_dictionary(raw_conditions: DataFrame) -> DataFrame:
    """STR-04/AGG-12: one row per non-blank code, one description (the smallest)."""
    return (
        raw_conditions.where(C.blank_to_null("CODE").isNotNull())
        .groupBy(F.col("CODE").alias("snomed_code"))
        .agg(F.min("DESCRIPTION").alias("description"))
    )


def _parse_dates(df: DataFrame, dates: dict) -> DataFrame:
    """Parse each date once in its own projection.

    ``date_key`` reads its input three times (year, month, day); parsing in a
    separate projection keeps the guarded parse (regex + try-cast) to one
    evaluation per value — the optimizer does not re-inline an expensive
    expression that is referenced several times.
    """
    return df.select("*", *[e.alias(n) for n, e in dates.items()])


def _dim_lookup(dim: DataFrame, id_col: str, key_col: str, alias: str) -> DataFrame:
    return dim.select(F.col(id_col).alias(f"_{alias}_id"), F.col(key_col).alias(alias))


def typed_encounters(raw: DataFrame, dim_patient: DataFrame, dim_provider: DataFrame) -> DataFrame:
    """STR-05 without keys: JOI-03 left lookups keep orphans with NULL keys."""
    p = _dim_lookup(dim_patient, "patient_id", "patient_key", "patient_key")
    v = _dim_lookup(dim_provider, "provider_id", "provider_key", "provider_key")
    j = raw.join(p, raw["PATIENT"] == p["_patient_key_id"], "left").join(
        v, raw["PROVIDER"] == v["_provider_key_id"], "left"
    )
    j = _parse_dates(j, {"_start": C.iso_prefix_to_date("START"), "_stop": C.iso_prefix_to_date("STOP")})
    return j.select(
        "patient_key",
        "provider_key",
        C.date_key("_start").alias("start_date_key"),
        C.date_key("_stop").alias("stop_date_key"),
        F.col("Id").alias("encounter_id"),
        F.col("ENCOUNTERCLASS").alias("encounter_class"),
        F.col("DESCRIPTION").alias("description"),
        C.try_decimal("BASE_ENCOUNTER_COST").alias("base_cost"),
        C.try_decimal("TOTAL_CLAIM_COST").alias("total_claim_cost"),
        C.try_decimal("PAYER_COVERAGE").alias("payer_coverage"),
        C.blank_to_null("REASONCODE").alias("reason_code"),
        C.blank_to_null("REASONDESCRIPTION").alias("reason_description"),
    )


def _episode_keys(raw: DataFrame, dim_patient: DataFrame, fact_encounter: DataFrame) -> DataFrame:
    p = _dim_lookup(dim_patient, "patient_id", "patient_key", "patient_key")
    e = _dim_lookup(fact_encounter, "encounter_id", "encounter_key", "encounter_key")
    return raw.join(p, raw["PATIENT"] == p["_patient_key_id"], "left").join(
        e, raw["ENCOUNTER"] == e["_encounter_key_id"], "left"
    )


def typed_conditions(raw: DataFrame, dim_patient: DataFrame, fact_encounter: DataFrame) -> DataFrame:
    """STR-06 without keys; blank stop -> NULL (still active, SCL-06)."""
    j = _episode_keys(raw, dim_patient, fact_encounter)
    j = _parse_dates(j, {"_start": C.iso_prefix_to_date("START"), "_stop": C.optional_date("STOP")})
    return j.select(
        "patient_key",
        "encounter_key",
        C.date_key("_start").alias("start_date_key"),
        C.date_key("_stop").alias("stop_date_key"),
        F.col("CODE").alias("snomed_code"),
        F.col("DESCRIPTION").alias("description"),
        F.col("PATIENT").alias("patient_id"),
    )


def typed_medications(raw: DataFrame, dim_patient: DataFrame, fact_encounter: DataFrame) -> DataFrame:
    """STR-07 without keys; blank code -> NULL."""
    j = _episode_keys(raw, dim_patient, fact_encounter)
    j = _parse_dates(j, {"_start": C.iso_prefix_to_date("START"), "_stop": C.optional_date("STOP")})
    return j.select(
        "patient_key",
        "encounter_key",
        C.date_key("_start").alias("start_date_key"),
        C.date_key("_stop").alias("stop_date_key"),
        C.blank_to_null("CODE").alias("rxnorm_code"),
        F.col("DESCRIPTION").alias("description"),
        C.try_decimal("BASE_COST").alias("base_cost"),
        C.try_decimal("TOTALCOST").alias("total_cost"),
        C.try_integer("DISPENSES").alias("dispenses"),
        C.try_decimal("PAYER_COVERAGE").alias("payer_coverage"),
        F.col("PATIENT").alias("patient_id"),
    )


# FIXED VALUES: the natural key of each table, which must not be NULL in the dimensions and
# the encounters and must not repeat there.
NATURAL_KEYS = {
    "dim_date": ["date_key"], "dim_patient": ["patient_id"], "dim_provider": ["provider_id"],
    "dim_condition_code": ["snomed_code"], "fact_encounter": ["encounter_id"],
}


def _append(
    build: StarBuild,
    name: str,
    incoming: DataFrame,
    existing: DataFrame | None,
    natural_key: list[str],
    key_col: str,
    *,
    null_parts: str,
    dedupe: bool,
    order: list[str] | None = None,
) -> DataFrame:
    if name in NATURAL_KEYS:
        # a NULL natural key: kept apart, not stored and not an abort of the whole load
        bad = check_not_null(incoming, NATURAL_KEYS[name])
        build.rejected[name] = bad
        incoming = incoming.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in NATURAL_KEYS[name]]))
    # written once: the sampling of the range partitions, the sort and the de-duplication each read the parsed and joined rows
    new = stable_table(insert_if_absent(incoming, existing, natural_key, null_parts=null_parts), name)
    if dedupe:
        new, build.duplicates[name] = split_duplicates(new, natural_key, null_parts)
    keyed = assign_surrogate_keys(new, order or natural_key, key_col, max_key(existing, key_col))
    keyed = schema_conform(keyed, STAR_SCHEMAS[name])
    build.appended[name] = keyed
    build.tables[name] = _union(existing, keyed)
    return build.tables[name]


def build_star(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    existing: dict[str, DataFrame] | None = None,
    *,
    calendar: tuple[str, str] = codes.REFERENCE_CALENDAR,
    null_parts: str = "row",
    dedupe: bool = False,
    calendar_policy: str = "quarantine",
    targets: list[str] | None = None,
) -> StarBuild:
    """STR-08: build (or extend) the star schema in dependency order.

    ``null_parts`` says what a NULL part of a natural key matches (see
    :func:`insert_if_absent`; ``never`` is the reference's guard). Facts know
    their patient by the raw id, so unknown patients stay apart. ``dedupe=True``
    keeps one episode per natural key; what it removes is in ``duplicates``. ``calendar_policy`` is
    ``quarantine`` (default) or ``fail`` for start dates outside the calendar.
    """
    ex = existing or {}
    b = StarBuild()
    want = set(targets or STAR_SCHEMAS)
    facts = {"fact_encounter", "fact_condition", "fact_medication"}
    need_enc = bool(want & facts)
    need_pat = need_enc or "dim_patient" in want
    need_prov = need_enc or "dim_provider" in want
    # STR-01: calendar
    cal = calendar_dim(spark, calendar)
    _cal_new = insert_if_absent(cal, ex.get("dim_date"), ["date_key"])
    b.appended["dim_date"] = _cal_new
    b.tables["dim_date"] = _union(ex.get("dim_date"), _cal_new)
    dim_date = b.tables["dim_date"]
    # STR-02..04: dimensions
    dp = dv = fe = None
    if need_pat:
        dp = _append(b, "dim_patient", typed_patients(raw["raw_patients"]), ex.get("dim_patient"),
                     ["patient_id"], "patient_key", null_parts=null_parts, dedupe=True)
    if need_prov:
        dv = _append(b, "dim_provider", typed_providers(raw["raw_providers"]), ex.get("dim_provider"),
                     ["provider_id"], "provider_key", null_parts=null_parts, dedupe=True)
    if "dim_condition_code" in want:
        _append(b, "dim_condition_code", code_dictionary(raw["raw_conditions"]),
                ex.get("dim_condition_code"), ["snomed_code"], "code_key", null_parts=null_parts,
                dedupe=True)
    # STR-05: encounters, quarantining calendar violations (defect 1)
    if need_enc:
        enc = typed_encounters(raw["raw_encounters"], dp, dv)
        enc, q_enc = _calendar_guard(enc, dim_date, ["start_date_key", "stop_date_key"], calendar_policy)
        b.quarantined["fact_encounter"] = q_enc
        fe = _append(b, "fact_encounter", enc, ex.get("fact_encounter"), ["encounter_id"],
                     "encounter_key", null_parts=null_parts, dedupe=True)
    # STR-06/07: condition and medication episodes (composite natural keys)
    if "fact_condition" in want:
        cond = typed_conditions(raw["raw_conditions"], dp, fe)
        cond, q_cond = _calendar_guard(cond, dim_date, ["start_date_key"], calendar_policy)
        b.quarantined["fact_condition"] = q_cond
        ckey = ["patient_id", "snomed_code", "start_date_key"]
        _append(b, "fact_condition", cond, ex.get("fact_condition"), ckey, "condition_key",
                null_parts=null_parts, dedupe=dedupe,
                order=["patient_key", *ckey[1:], "encounter_key", "stop_date_key", "description", "patient_id"])
    if "fact_medication" in want:
        med = typed_medications(raw["raw_medications"], dp, fe)
        med, q_med = _calendar_guard(med, dim_date, ["start_date_key"], calendar_policy)
        b.quarantined["fact_medication"] = q_med
        mkey = ["patient_id", "rxnorm_code", "start_date_key"]
        _append(b, "fact_medication", med, ex.get("fact_medication"), mkey, "medication_key",
                null_parts=null_parts, dedupe=dedupe,
                order=["patient_key", *mkey[1:], "encounter_key", "stop_date_key", "description", "total_cost",
                       "dispenses", "base_cost", "payer_coverage", "patient_id"])
    return b


def _calendar_guard(df: DataFrame, dim_date: DataFrame, key_cols: list[str], policy: str):
    """Split rows whose (non-NULL) date keys are missing from the calendar.

    After a check of the calendar's size it is broadcast and each key is flagged with a left join — no shuffle of
    the fact rows, no row ids.
    """
    if policy == "none":
        return df, df.limit(0)
    keys = dim_date.select(F.col("date_key").alias("_cal_key")).distinct()
    if small_enough(dim_date):
        keys = F.broadcast(keys)
    flagged = df
    bad = F.lit(False)
    for i, k in enumerate(key_cols):
        kk = keys.select(F.col("_cal_key").alias(f"_cal_{i}"), F.lit(True).alias(f"_ok_{i}"))
        flagged = flagged.join(kk, F.col(k) == F.col(f"_cal_{i}"), "left")
        bad = bad | (F.col(k).isNotNull() & F.col(f"_ok_{i}").isNull())
    helper = [c for i in range(len(key_cols)) for c in (f"_cal_{i}", f"_ok_{i}")]
    flagged = flagged.withColumn("_bad", bad).drop(*helper)
    if policy == "fail":
        if flagged.where("_bad").limit(1).count():
            raise ConstraintViolation(f"calendar foreign key violated on {key_cols}")
    return flagged.where(~F.col("_bad")).drop("_bad"), flagged.where(F.col("_bad")).drop("_bad")


def check_star(tables: dict[str, DataFrame]) -> DataFrame:
    """STR-09: (table_name, key_column, violations) of the star's constraints: natural and surrogate
    keys not NULL and unique. One aggregate per table and key; all zero for tables that build_star made."""
    parts = []
    for name, keys in NATURAL_KEYS.items():
        if name not in tables:
            continue
        surrogate = STAR_SCHEMAS[name].fields[0].name
        for key in dict.fromkeys([surrogate, *keys]):
            nulls = tables[name].agg(F.count_if(F.col(key).isNull()).alias("n"))
            twice = check_unique(tables[name].where(F.col(key).isNotNull()), [key]).agg(F.count(F.lit(1)).alias("n"))
            for kind, d in (("not null", nulls), ("unique", twice)):
                parts.append(d.select(F.lit(name).alias("table_name"), F.lit(key).alias("key_column"), F.lit(kind).alias("rule"),
                                      F.col("n").alias("violations")))
    return reduce(lambda a, b: a.unionByName(b), parts)


# -- adapters: star tables -> mart inputs -----------------------------------
def mart_inputs(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Star tables in the column shape the marts expect (dates from keys)."""
    fe = tables["fact_encounter"]
    fc = tables.get("fact_condition")
    dp = tables["dim_patient"]
    encounters = fe.select(
        "encounter_key",
        "patient_key",
        C.date_from_key("start_date_key").alias("start_date"),
        C.date_from_key("stop_date_key").alias("stop_date"),
        "encounter_class",
        "total_claim_cost",
    )
    conditions = None if fc is None else fc.select(
        "patient_key",
        "encounter_key",
        C.date_from_key("start_date_key").alias("start_date"),
        C.date_from_key("stop_date_key").alias("stop_date"),
        F.col("snomed_code").alias("code"),
        "description",
    )
    patients = dp.select("patient_key", "patient_id", "birthdate", "deathdate", "gender", "state",
                         "healthcare_expenses")
    return {"encounters": encounters, "conditions": conditions, "patients": patients}
