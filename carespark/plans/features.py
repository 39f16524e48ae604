"""Patient feature frame (MRT-06, ML-01/02) and the high-cost label (WIN-05, ML-03)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespark import codes
from carespark.functions.columns import as_of_date, year_boundary_age
from carespark.operators.ordered import global_row_number
from carespark.operators.selection import top_rows
from carespark.plans.analytics import patient_condition_flags


def encounter_totals(encounters: DataFrame) -> DataFrame:
    """Per patient: encounter count and exact (decimal) cost sum."""
    return encounters.groupBy("patient_key").agg(
        F.count(F.lit(1)).alias("encounter_count"),
        F.sum("total_claim_cost").alias("total_cost"),
    )


def alive(patients: DataFrame, as_of: str | None = None) -> DataFrame:
    """Patients without a date of death on or before ``as_of``."""
    return patients.where(F.col("deathdate").isNull() | (F.col("deathdate") > as_of_date(as_of)))


def patient_features(
    patients: DataFrame,
    encounters: DataFrame,
    conditions: DataFrame,
    *,
    condition_sets: dict,
    as_of: str | None = None,
    exclude_label_source: bool = False,
    exclude_deceased: bool = False,
) -> DataFrame:
    """One row per patient: patient_key, patient_id and the 10 risk features (DOUBLE).

    Missing aggregates become 0 (the reference coerces NULL to 0.0).
    Both per-patient aggregates are computed before the joins, so all three
    inputs meet hash-partitioned on patient_key.
    """
    if exclude_deceased:  # by default the dead stay, as in the reference
        patients = alive(patients, as_of)
    pc = patient_condition_flags(conditions, condition_sets)
    et = encounter_totals(encounters)
    p = patients.select("patient_key", "patient_id", "birthdate", "gender", "healthcare_expenses")
    j = p.join(pc, "patient_key", "left").join(et, "patient_key", "left")
    z = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    feats = {
        "age_years": F.coalesce(
            year_boundary_age(as_of_date(as_of), "birthdate").cast("double"), F.lit(0.0)
        ),
        "is_male": F.when(F.col("gender") == "M", 1.0).otherwise(0.0),
        "condition_count": z("condition_count"),
        "has_diabetes": z("has_diabetes"),
        "has_heart_failure": z("has_heart_failure"),
        "has_hypertension": z("has_hypertension"),
        "has_copd_asthma": z("has_copd_asthma"),
        "encounter_count": z("encounter_count"),
        "total_encounter_cost": z("total_cost"),
        "healthcare_expenses": z("healthcare_expenses"),
    }
    names = [f for f in codes.RISK_FEATURES if not (exclude_label_source and f == "healthcare_expenses")]
    return j.select("patient_key", "patient_id", *[feats[f].alias(f) for f in names])


def features_of(
    patient_ids: list[str],
    patients: DataFrame,
    encounters: DataFrame,
    conditions: DataFrame,
    *,
    max_ids: int = 10_000,
    **options,
) -> DataFrame:
    """FLT-07: feature rows of the patients asked for. Their keys restrict both facts
    before anything is aggregated; the list's length is checked, so the keys may
    be broadcast."""
    if len(patient_ids) > max_ids:
        raise ValueError("too many ids for a lookup: use patient_features and a join")
    asked = patients.where(F.col("patient_id").isin(patient_ids))
    keys = F.broadcast(asked.select("patient_key"))
    return patient_features(asked, encounters.join(keys, "patient_key", "left_semi"),
                            conditions.join(keys, "patient_key", "left_semi"), **options)


def high_cost_label(
    features: DataFrame,
    *,
    cost_col: str = "healthcare_expenses",
    fraction: float = codes.HIGH_COST_FRACTION,
    key_col: str = "patient_key",
) -> DataFrame:
    """Label 1 for the first max(1, floor(n * fraction)) rows by cost desc, key asc.

    Ties are split by the key, not all admitted, like in the reference. The cost at the last place
    is found by counting, so no row is sorted or numbered."""
    top = top_rows(features, cost_col, key_col, lambda n: max(1, int(n * fraction)))
    return features.withColumn("label", F.when(top, 1).otherwise(0))


def high_cost_rank(
    features: DataFrame,
    *,
    cost_col: str = "healthcare_expenses",
    fraction: float = codes.HIGH_COST_FRACTION,
    key_col: str = "patient_key",
) -> DataFrame:
    """The label beside every row's place, by the distributed global row number."""
    ranked, n = global_row_number(
        features, [F.col(cost_col).desc_nulls_last(), F.col(key_col).asc_nulls_first()], "cost_rank",
        with_count=True,
    )
    top_n = max(1, int(n * fraction))
    return ranked.withColumn("label", F.when(F.col("cost_rank") <= top_n, 1).otherwise(0))
