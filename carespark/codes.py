"""Domain constants: condition code sets, PHI field names, fixed texts.

FIXED VALUES — these must equal the reference's values for identical results.
They are stated once here, in natural order, and used by every operator.
"""

from __future__ import annotations

# ---- FIXED VALUES: SNOMED-CT condition code sets (flag -> codes) ----------
CLINICAL_CONDITION_SETS: dict[str, list[str]] = {
    "diabetes": ["44054006", "73211009"],
    "heart_failure": ["84114007"],
    "copd_asthma": ["13645005", "195967001"],
    "hypertension": ["59621000"],
}

# Driver binding over the Parquet test tables: p_brand plays the code role.
DRIVER_CONDITION_SETS: dict[str, list[str]] = {
    "diabetes": ["Brand#11", "Brand#12"],
    "heart_failure": ["Brand#13"],
    "copd_asthma": ["Brand#21", "Brand#22"],
    "hypertension": ["Brand#3"],
}

# Order of the condition flags in the feature frame.

# ---- FIXED VALUES: PHI field names that are masked -----------------------
PHI_FIELDS = ("patient_id", "birthdate", "deathdate", "ssn", "first", "last")
MASK_PREFIX = "****"
MASK_HEX_CHARS = 8

# ---- FIXED VALUES: risk feature names, in model order -------------------
RISK_FEATURES = [
    "age_years",
    "is_male",
    "condition_count",
    "has_diabetes",
    "has_heart_failure",
    "has_hypertension",
    "has_copd_asthma",
    "encounter_count",
    "total_encounter_cost",
    "healthcare_expenses",
]
MODEL_VERSION = "v0-logistic"

# ---- FIXED VALUES: care-gap narrative and prompt texts --------------------
NARRATIVE_NONE = "No open care gaps identified for this patient."
NARRATIVE_HEAD = "Patient has {n} open care gap(s): "
NARRATIVE_TAIL = " (and {k} more)"
NARRATIVE_END = ". Clinical review recommended."
NARRATIVE_MODEL = "stub"
PROMPT_NONE = "Patient {pid} has no open care gaps. Confirm in one sentence."
PROMPT_HEAD = "You are a clinical care coordinator. Patient {pid} has {n} open care gap(s):\n"
PROMPT_BULLET = "- "
PROMPT_END = (
    "\n\nWrite 2-3 sentences summarising these gaps and recommending next steps. "
    "Be concise and clinical. Do not add invented medical details."
)

# ---- FIXED VALUES: reference calendar range and gap windows ---------------
REFERENCE_CALENDAR = ("2000-01-01", "2030-12-31")
READMISSION_WINDOW_DAYS = 30
CARE_GAP_DAYS = 365
HIGH_COST_FRACTION = 0.25
