"""Patient care gaps (MRT-07, JOI-08/09, AGG-13) and their narrative (MRT-08, SCL-22/23)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespark import codes
from carespark.functions.columns import as_of_date, days_between
from carespark.plans.analytics import in_calendar


def recently_seen_patients(
    encounters: DataFrame, *, as_of: str | None, calendar: tuple[str, str], gap_days: int
) -> DataFrame:
    """Patients with an in-calendar encounter at most ``gap_days`` before as-of.

    Encounters after the as-of date count as recent (negative difference).
    """
    return (
        encounters.where(
            in_calendar("start_date", calendar)
            & (days_between(as_of_date(as_of), "start_date") <= gap_days)
        )
        .select("patient_key")
        .distinct()
    )


def patients_without_recent_encounter(
    patients: DataFrame,
    encounters: DataFrame,
    *,
    as_of: str | None = None,
    calendar: tuple[str, str] = codes.REFERENCE_CALENDAR,
    gap_days: int = codes.CARE_GAP_DAYS,
) -> DataFrame:
    """JOI-08: decorrelated NOT EXISTS as a ``left_anti`` join."""
    recent = recently_seen_patients(encounters, as_of=as_of, calendar=calendar, gap_days=gap_days)
    return patients.join(recent, "patient_key", "left_anti")


def patient_care_gaps(
    patients: DataFrame,
    encounters: DataFrame,
    conditions: DataFrame,
    *,
    as_of: str | None = None,
    calendar: tuple[str, str] = codes.REFERENCE_CALENDAR,
    gap_days: int = codes.CARE_GAP_DAYS,
    as_pairs: bool = False,
    exclude_deceased: bool = False,
) -> DataFrame:
    """Per patient: sorted list of active-condition descriptions when unseen for gap_days.

    Blank descriptions are dropped, duplicates kept, patients without gaps get
    an empty list. The collect is bounded: descriptions are first counted per
    (patient, description) — a partial aggregate — so a patient's list is
    built from at most one entry per distinct description and expanded with
    ``array_repeat`` at the end. ``as_pairs=True`` keeps the bounded form —
    ``gaps`` is then an array of (description, n) — for patients whose
    duplicate entries would make the expanded list arbitrarily long.
    """
    if exclude_deceased:  # by default the dead stay, as in the reference
        from carespark.plans.features import alive

        patients = alive(patients, as_of)
    recent = recently_seen_patients(encounters, as_of=as_of, calendar=calendar, gap_days=gap_days)
    active = conditions.where(
        # a condition without a patient has no row to be listed in, and all of them would meet in one group
        F.col("patient_key").isNotNull()
        & F.col("stop_date").isNull()
        & F.col("description").isNotNull()
        & (F.col("description") != "")
    ).select("patient_key", "description")
    gaps = active.join(recent, "patient_key", "left_anti")
    counted = gaps.groupBy("patient_key", "description").agg(F.count(F.lit(1)).alias("n"))
    per_patient = counted.groupBy("patient_key").agg(
        F.sort_array(F.collect_list(F.struct("description", "n"))).alias("_pairs")
    )
    expanded = F.flatten(
        F.transform("_pairs", lambda x: F.array_repeat(x["description"], x["n"].cast("int")))
    )
    out = patients.select("patient_key", "patient_id").join(per_patient, "patient_key", "left")
    if as_pairs:
        pairs = F.coalesce(F.col("_pairs"), F.array().cast("array<struct<description:string,n:bigint>>"))
        total = F.aggregate(pairs, F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
        return out.select("patient_key", "patient_id", pairs.alias("gaps"), total.alias("gap_count"))
    gaps_col = F.coalesce(expanded, F.array().cast("array<string>"))
    return out.select("patient_key", "patient_id", gaps_col.alias("gaps")).withColumn(
        "gap_count", F.size("gaps").cast("long")
    )


def first_gaps(pairs: Column, most: int) -> Column:
    """The first entries of the list that (description, n) pairs stand for, without building the list."""
    return F.slice(F.flatten(F.transform(
        F.slice(pairs, 1, most), lambda x: F.array_repeat(x["description"], F.least(x["n"], F.lit(most)).cast("int")))), 1, most)


def narrative_summary(first: Column, n: Column) -> Column:
    """SCL-22: deterministic summary text for n gaps, of which the first three are named."""
    listed = F.array_join(first, ", ")
    tail = F.when(
        n > 3,
        F.concat(
            F.lit(codes.NARRATIVE_TAIL.split("{k}")[0]),
            (n - 3).cast("string"),
            F.lit(codes.NARRATIVE_TAIL.split("{k}")[1]),
        ),
    ).otherwise(F.lit(""))
    head_a, head_b = codes.NARRATIVE_HEAD.split("{n}")
    return F.when(n == 0, F.lit(codes.NARRATIVE_NONE)).otherwise(
        F.concat(F.lit(head_a), n.cast("string"), F.lit(head_b), listed, tail, F.lit(codes.NARRATIVE_END))
    )


def care_gap_narrative(care_gaps: DataFrame) -> DataFrame:
    """MRT-08: patient_id, gaps as pairs, gap_count, summary, model_used='stub'.

    ``care_gaps`` as :func:`patient_care_gaps` gives it with ``as_pairs``: a
    summary names three gaps, so the list is never expanded."""
    return care_gaps.select(
        "patient_key",
        "patient_id",
        "gaps",
        "gap_count",
        narrative_summary(first_gaps(F.col("gaps"), 3), F.col("gap_count")).alias("summary"),
        F.lit(codes.NARRATIVE_MODEL).alias("model_used"),
    )


def care_gap_prompt(care_gaps: DataFrame) -> DataFrame:
    """SCL-23: the per-patient prompt text (bullet list, or the no-gap text), from pairs."""
    n = F.col("gap_count")
    pid = F.col("patient_id")
    none_a, none_b = codes.PROMPT_NONE.split("{pid}")
    head = codes.PROMPT_HEAD
    h1, rest = head.split("{pid}")
    h2, h3 = rest.split("{n}")
    bullets = F.array_join(F.transform("gaps", lambda g: F.array_join(
        F.array_repeat(F.concat(F.lit(codes.PROMPT_BULLET), g["description"]), g["n"].cast("int")), "\n")), "\n")
    text = F.when(n == 0, F.concat(F.lit(none_a), pid, F.lit(none_b))).otherwise(
        F.concat(F.lit(h1), pid, F.lit(h2), n.cast("string"), F.lit(h3), bullets, F.lit(codes.PROMPT_END))
    )
    return care_gaps.select("patient_key", "patient_id", text.alias("prompt"))
