"""The five analytical marts and their building blocks.

All functions take star-shaped DataFrames (column names of the star schema,
SURVEY §1.4) and return lazy DataFrames; nothing is collected. Inputs:

- encounters: encounter_key, patient_key, start_date, [stop_date],
  encounter_class, total_claim_cost (DECIMAL)
- conditions: patient_key, code, stop_date (NULL = active), description

``calendar`` = (first, last) ISO dates. The reference inner-joins each fact
to its calendar table, which drops NULL and out-of-range dates; the same
effect is a range predicate on the date (P6), so no join is needed here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carespark import codes
from carespark.functions.columns import as_of_date, days_between, round2, round_double, safe_pct
from carespark.operators.ordered import ordered_scan
from carespark.operators.percentiles import exact_percentiles


def in_calendar(c: Column | str, calendar: tuple[str, str]) -> Column:
    """True when the date lies inside the calendar range (NULL -> false)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.between(F.to_date(F.lit(calendar[0])), F.to_date(F.lit(calendar[1])))


# -- building blocks ----------------------------------------------------------
def without_orphans(df: DataFrame, orphans: str) -> DataFrame:
    """P13: ``keep`` (as the reference) or ``drop`` rows whose patient is unknown."""
    if orphans not in ("keep", "drop"):
        raise ValueError(f"orphans: {orphans}")
    return df if orphans == "keep" else df.where(F.col("patient_key").isNotNull())


def prior_discharge(inpatient: DataFrame) -> DataFrame:
    """WIN-01: previous stay's discharge per patient in admit order.

    Input columns patient_key, encounter_key, admit_date, discharge_date.
    LAG looks one row back (not the max of all earlier discharges); the
    encounter key breaks same-day ties. Skew-safe (range partitioned).
    """
    return ordered_scan(
        inpatient,
        ["patient_key"],
        ["admit_date", "encounter_key"],
        lag={"prior_discharge": "discharge_date"},
    )


def patient_condition_flags(conditions: DataFrame, condition_sets: dict) -> DataFrame:
    """Per patient: distinct code count and 0/1 "ever diagnosed" flags (P14).

    One partial (map-side) aggregate; the distinct count is planned by Spark
    as an aggregate on (patient, code) first, so a hot patient is split by code.
    """
    flags = [
        F.max(F.when(F.col("code").isin(list(condition_sets[name])), 1).otherwise(0)).alias(
            f"has_{name}"
        )
        for name in ("diabetes", "heart_failure", "copd_asthma", "hypertension")
    ]
    return conditions.groupBy("patient_key").agg(
        F.countDistinct("code").alias("condition_count"), *flags
    )


def first_encounter_year(encounters: DataFrame, calendar: tuple[str, str]) -> DataFrame:
    """AGG-07: year of each patient's first in-calendar encounter."""
    return (
        encounters.where(in_calendar("start_date", calendar))
        .groupBy("patient_key")
        .agg(F.year(F.min("start_date")).alias("first_encounter_year"))
    )


def last_encounter(encounters: DataFrame, calendar: tuple[str, str]) -> DataFrame:
    """AGG-07: date of each patient's latest in-calendar encounter start."""
    return (
        encounters.where(in_calendar("start_date", calendar))
        .groupBy("patient_key")
        .agg(F.max("start_date").alias("last_encounter_date"))
    )


def active_condition_patients(conditions: DataFrame, code_set: list[str]) -> DataFrame:
    """FLT-02/03/09: distinct patients with a still-active condition in the set."""
    return (
        conditions.where(F.col("code").isin(list(code_set)) & F.col("stop_date").isNull())
        .select("patient_key")
        .distinct()
    )


# -- MRT-01 -----------------------------------------------------------------
def inpatient_stays(
    encounters_with_stop: DataFrame, *, inpatient_class: str, calendar: tuple[str, str]
) -> DataFrame:
    """FLT-01 + JOI-02: inpatient stays with both dates inside the calendar."""
    return encounters_with_stop.where(
        (F.col("encounter_class") == inpatient_class)
        & in_calendar("start_date", calendar)
        & in_calendar("stop_date", calendar)
    ).select(
        "patient_key",
        "encounter_key",
        F.col("start_date").alias("admit_date"),
        F.col("stop_date").alias("discharge_date"),
    )


def readmission_rate(
    encounters_with_stop: DataFrame,
    *,
    inpatient_class: str = "inpatient",
    calendar: tuple[str, str] = codes.REFERENCE_CALENDAR,
    window_days: int = codes.READMISSION_WINDOW_DAYS,
    orphans: str = "keep",
) -> DataFrame:
    """30-day readmission rate per admit year.

    Inpatient stays with both dates in the calendar; a stay is a readmission
    when the patient's previous stay (by admit date) ended at most
    ``window_days`` before this admit (same-day and overlapping stays count).
    Stays of unknown patients count as one patient's, as in the reference;
    ``orphans="drop"`` leaves them out.
    """
    scanned = prior_discharge(
        inpatient_stays(without_orphans(encounters_with_stop, orphans), inpatient_class=inpatient_class, calendar=calendar)
    )
    readmit = F.col("prior_discharge").isNotNull() & (
        days_between("admit_date", "prior_discharge") <= window_days
    )
    return (
        scanned.groupBy(F.year("admit_date").alias("encounter_year"))
        .agg(F.count(F.lit(1)).alias("total_admissions"), F.count_if(readmit).alias("readmissions"))
        .select(
            "encounter_year",
            "total_admissions",
            "readmissions",
            safe_pct("readmissions", "total_admissions").alias("readmission_rate_pct"),
        )
        .orderBy(F.asc_nulls_last("encounter_year"))
    )


# -- MRT-02 -----------------------------------------------------------------
def cohort_segmentation(
    encounters: DataFrame,
    conditions: DataFrame,
    *,
    condition_sets: dict,
    calendar: tuple[str, str] = codes.REFERENCE_CALENDAR,
) -> DataFrame:
    """Chronic-condition cohorts by year of each patient's first encounter.

    Aggregate-before-join: both sides are one row per patient, so they are
    co-partitioned on patient_key for the join (no extra shuffle).
    """
    py = first_encounter_year(encounters, calendar)
    pc = patient_condition_flags(conditions, condition_sets)
    j = py.join(pc, "patient_key", "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    return (
        j.groupBy(F.col("first_encounter_year").alias("encounter_year"))
        .agg(
            F.count(F.lit(1)).alias("total_patients"),
            F.sum(z("has_diabetes")).cast("long").alias("diabetes_cohort"),
            F.sum(z("has_heart_failure")).cast("long").alias("heart_failure_cohort"),
            F.sum(z("has_copd_asthma")).cast("long").alias("copd_asthma_cohort"),
            F.sum(z("has_hypertension")).cast("long").alias("hypertension_cohort"),
            round_double(F.avg(z("condition_count").cast("double"))).alias("avg_condition_count"),
        )
        .orderBy(F.asc_nulls_last("encounter_year"))
    )


# -- MRT-03 -----------------------------------------------------------------
COST_PERCENTILES = {"p50_cost": 0.50, "p90_cost": 0.90, "p99_cost": 0.99}


def cost_benchmarking(
    encounters: DataFrame,
    *,
    calendar: tuple[str, str] = codes.REFERENCE_CALENDAR,
    percentiles: dict[str, float] | None = None,
    approximate: bool = False,
    accuracy: int = 10000,
) -> DataFrame:
    """Cost distribution per year: distinct patients, avg, exact p50/p90/p99, max.

    ``approximate=True`` computes everything in one partial aggregate with
    bounded, mergeable sketches: ``approx_count_distinct`` (HLL++, ~1 %
    relative error) and ``percentile_approx`` (rank error about 1/accuracy).

    ``top_quartile_count`` is the size of NTILE(4) bucket 4, which is always
    floor(n/4) whatever the ties (P7) — no per-year window needed. The
    percentiles come from a rank (not a per-year value map) and are joined
    to the one-row-per-year aggregate (P9).
    """
    probs = percentiles or COST_PERCENTILES
    enc = encounters.where(
        in_calendar("start_date", calendar) & F.col("total_claim_cost").isNotNull()
    ).select(
        F.year("start_date").alias("encounter_year"),
        "patient_key",
        F.col("total_claim_cost").alias("cost"),
    )
    if approximate:
        names = list(probs)
        agg = enc.groupBy("encounter_year").agg(
            F.approx_count_distinct("patient_key").alias("patient_count"),
            F.count(F.lit(1)).alias("_n"),
            F.sum("cost").alias("_sum"),
            F.max("cost").alias("_max"),
            F.percentile_approx(F.col("cost").cast("double"), [probs[k] for k in names], accuracy).alias("_p"),
        )
        return agg.select(
            "encounter_year",
            F.col("patient_count").cast("long").alias("patient_count"),
            round_double(F.col("_sum").cast("double") / F.col("_n")).alias("avg_cost"),
            *[round_double(F.col("_p")[i]).alias(k) for i, k in enumerate(names)],
            round2("_max").alias("max_cost"),
            F.floor(F.col("_n") / 4).cast("long").alias("top_quartile_count"),
        ).orderBy(F.asc_nulls_last("encounter_year"))
    # One aggregate for the count, sum, max and the (single) distinct count:
    # Spark plans a single distinct aggregate as two partial-aggregate phases
    # over (year, patient), no Expand and no per-group value buffers.
    stats = enc.groupBy("encounter_year").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("cost").alias("_sum"),
        F.max("cost").alias("_max"),
        F.countDistinct("patient_key").alias("patient_count"),
    )
    pct = exact_percentiles(enc, ["encounter_year"], "cost", probs)
    out = stats.join(pct, "encounter_year")
    return out.select(
        "encounter_year",
        "patient_count",
        round_double(F.col("_sum").cast("double") / F.col("_n")).alias("avg_cost"),
        *[round_double(k).alias(k) for k in probs],
        round2("_max").alias("max_cost"),
        F.floor(F.col("_n") / 4).cast("long").alias("top_quartile_count"),
    ).orderBy(F.asc_nulls_last("encounter_year"))


def cost_quartiles(
    encounters: DataFrame, *, calendar: tuple[str, str] = codes.REFERENCE_CALENDAR
) -> DataFrame:
    """WIN-03 row level: NTILE(4) of cost within each year (cost, key order).

    Computed from a skew-safe rank and the per-year count, so one year is not
    forced into one task.
    """
    enc = encounters.where(
        in_calendar("start_date", calendar) & F.col("total_claim_cost").isNotNull()
    ).select(
        "encounter_key",
        "patient_key",
        F.year("start_date").alias("encounter_year"),
        F.col("total_claim_cost").alias("cost"),
    )
    from carespark.operators.ordered import grouped_row_number, ntile_from_rank

    ranked = grouped_row_number(enc, ["encounter_year"], ["cost", "encounter_key"], "cost_rank", count_col="_n")
    return ranked.select(
        "encounter_key",
        "patient_key",
        "encounter_year",
        F.col("cost").cast("double").alias("total_claim_cost"),
        "cost_rank",
        ntile_from_rank(F.col("cost_rank"), F.col("_n"), 4).alias("cost_quartile"),
    )


# -- MRT-04 -----------------------------------------------------------------
def care_gap_flags(
    patients: DataFrame,
    encounters: DataFrame,
    *,
    calendar: tuple[str, str],
    as_of: str | None = None,
    gap_days: int = codes.CARE_GAP_DAYS,
) -> DataFrame:
    """Per patient: last encounter and a care-gap flag (none, or > gap_days ago).

    ``as_of`` defaults to today's date (SCL-11)."""
    le = last_encounter(encounters, calendar)
    j = patients.select("patient_key").join(le, "patient_key", "left")
    gap = F.col("last_encounter_date").isNull() | (
        days_between(as_of_date(as_of), "last_encounter_date") > gap_days
    )
    return j.withColumn("care_gap", gap)


def care_gap_rate(
    encounters: DataFrame,
    conditions: DataFrame,
    *,
    code_set: list[str],
    as_of: str | None = None,
    calendar: tuple[str, str] = codes.REFERENCE_CALENDAR,
    gap_days: int = codes.CARE_GAP_DAYS,
) -> DataFrame:
    """One row: active-diabetes patients, those with a care gap, and the rate.

    A global aggregate, so it returns one row (0, 0, NULL) on empty input.
    """
    flagged = care_gap_flags(
        active_condition_patients(conditions, code_set),
        encounters,
        calendar=calendar,
        as_of=as_of,
        gap_days=gap_days,
    )
    return flagged.agg(
        F.count(F.lit(1)).alias("diabetic_patients"),
        F.count_if(F.col("care_gap")).alias("patients_with_care_gap"),
    ).select(
        "diabetic_patients",
        "patients_with_care_gap",
        safe_pct("patients_with_care_gap", "diabetic_patients").alias("care_gap_rate_pct"),
    )


# -- MRT-05 -----------------------------------------------------------------
def utilization_base(
    encounters: DataFrame, *, calendar: tuple[str, str] = codes.REFERENCE_CALENDAR
) -> DataFrame:
    """AGG-01/05/09: encounter count and exact cost sum per year and class."""
    return (
        encounters.where(in_calendar("start_date", calendar))
        .groupBy(F.year("start_date").alias("encounter_year"), "encounter_class")
        .agg(
            F.count(F.lit(1)).alias("encounter_count"),
            F.round(F.sum("total_claim_cost"), 2).alias("total_cost"),
        )
    )


def utilization_trends(
    encounters: DataFrame, *, calendar: tuple[str, str] = codes.REFERENCE_CALENDAR
) -> DataFrame:
    """Year-over-year change per class against the previous *present* year.

    The window runs over the already aggregated (year, class) table, whose
    size is bounded by #years x #classes, so a plain Window is right here.
    One window spec, one LAG per measure (P11).
    """
    yearly = utilization_base(encounters, calendar=calendar)
    w = Window.partitionBy("encounter_class").orderBy(F.asc_nulls_last("encounter_year"))
    prev_n = F.lag("encounter_count").over(w)
    prev_c = F.lag("total_cost").over(w)
    t = yearly.select("*", prev_n.alias("_pn"), prev_c.alias("_pc"))
    return t.select(
        "encounter_year",
        "encounter_class",
        "encounter_count",
        F.col("total_cost").cast("double").alias("total_cost"),
        (F.col("encounter_count") - F.col("_pn")).alias("count_delta"),
        safe_pct(F.col("encounter_count") - F.col("_pn"), "_pn").alias("count_growth_pct"),
        (F.col("total_cost") - F.col("_pc")).cast("double").alias("cost_delta"),
        safe_pct(F.col("total_cost") - F.col("_pc"), "_pc").alias("cost_growth_pct"),
    ).orderBy(F.asc_nulls_last("encounter_year"), F.asc_nulls_last("encounter_class"))
