"""Assembly of the one-row-per-patient journey and its feature subset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sojourn.functions.expr import sql_columns
from sojourn.operators.pathway import first_events, first_record
from sojourn.params import Params

#: Columns in the order of the table.
JOURNEY_COLUMNS = (
    "patient_id",
    "age_at_index",
    "comorbidity_score",
    "frailty_proxy",
    "region",
    "insurance_type",
    "synthetic_scenario_version",
    "prostate_stage",
    "metastatic_flag",
    "hormone_sensitive_flag",
    "castration_resistant_flag",
    "mhspc_flag",
    "eligibility_date",
    "eligible_for_arpi",
    "eligibility_rule_version",
    "initial_care_setting",
    "initial_provider_specialty",
    "multidisciplinary_team_flag",
    "first_urology_date",
    "first_oncology_date",
    "referral_completed_flag",
    "referral_delay_days",
    "initial_treatment",
    "initial_treatment_class",
    "treatment_start_date",
    "discontinuation_flag",
    "discontinuation_date",
    "discontinuation_reason",
    "switch_flag",
    "switch_date",
    "switched_to_drug",
    "restart_flag",
    "restart_date",
    "treatment_initiated",
    "days_to_initiation",
    "initiated_within_30d",
    "initiated_within_60d",
    "initiated_within_90d",
    "eligible_not_initiated_90d",
    "persistent_3m",
    "persistent_6m",
    "persistent_12m",
    "persistent_12m_gap_30d",
    "persistent_12m_gap_60d",
    "persistent_12m_gap_90d",
    "discontinued_within_12m",
    "days_to_discontinuation",
    "days_to_switch",
    "progression_event",
    "progression_date",
    "castration_resistant_transition",
    "castration_resistant_date",
    "hospitalisation_flag",
    "first_hospitalisation_date",
    "adverse_event_flag",
    "adverse_event_type",
    "death_flag",
    "death_date",
    "lost_to_follow_up_flag",
    "last_observed_date",
    "censor_date",
    "final_outcome_status",
    "days_to_progression",
    "follow_up_days",
    "synthetic_data_flag",
)

#: The feature subset.
FEATURE_COLUMNS = (
    "patient_id",
    "age_at_index",
    "comorbidity_score",
    "frailty_proxy",
    "region",
    "insurance_type",
    "prostate_stage",
    "metastatic_flag",
    "initial_care_setting",
    "initial_provider_specialty",
    "referral_delay_days",
    "eligible_not_initiated_90d",
)

#: Columns of the first treatment that a journey carries; two go under other names there.
FIRST_TREATMENT = (
    "drug_name", "drug_class", "treatment_start_date", "discontinuation_flag", "discontinuation_date",
    "discontinuation_reason", "switch_flag", "switch_date", "switched_to_drug", "restart_flag", "restart_date",
    "covered_until_date", "max_refill_gap_days",
)
INITIAL = {"drug_name": "initial_treatment", "drug_class": "initial_treatment_class"}


def first_treatment(treatment: DataFrame) -> DataFrame:
    """The whole first treatment row per patient, by start date and then line."""
    row = first_record(treatment, "patient_id", ("treatment_start_date", "treatment_line"), FIRST_TREATMENT)
    return row.withColumnsRenamed(INITIAL)


def initiation_columns(params: Params) -> dict[str, Column]:
    """Initiation and gap flags; needs eligibility and treatment start."""
    delay = "datediff(treatment_start_date, eligibility_date)"
    columns = {
        "treatment_initiated": "treatment_start_date IS NOT NULL",
        "days_to_initiation": f"cast({delay} AS BIGINT)",
        "eligible_not_initiated_90d": f"coalesce(eligible_for_arpi AND NOT coalesce({delay} BETWEEN 0 AND 90, false), false)",
    }
    for days in params.initiation_windows:
        columns[f"initiated_within_{days}d"] = f"coalesce(eligible_for_arpi AND {delay} BETWEEN 0 AND {days}, false)"
    return sql_columns(columns)


def persistence_columns(params: Params) -> dict[str, Column]:
    """Landmark persistence and its gap sensitivity; needs follow_up_days."""

    def persistent(days: int) -> str:
        landmark = f"date_add(treatment_start_date, {days})"
        stopped = f"coalesce(discontinuation_flag AND discontinuation_date <= {landmark}, false)"
        return f"coalesce({landmark} <= covered_until_date AND follow_up_days >= {days}, false) AND NOT {stopped}"

    columns = {f"persistent_{m}m": persistent(days) for m, days in params.persistence_landmarks}
    for limit in params.persistence_sensitivity_gaps:
        within = f"coalesce(max_refill_gap_days, 999) <= {limit}"
        columns[f"persistent_12m_gap_{limit}d"] = f"{persistent(365)} AND {within}"
    return sql_columns(columns)


def elapsed_columns() -> dict[str, Column]:
    """Elapsed days between the dates of one journey row."""
    follow_up = "datediff(censor_date, eligibility_date)"
    spans = {
        "days_to_discontinuation": "datediff(discontinuation_date, treatment_start_date)",
        "days_to_switch": "datediff(switch_date, treatment_start_date)",
        "days_to_progression": "datediff(progression_date, eligibility_date)",
        # A bare greatest would turn a null into 0.
        "follow_up_days": f"CASE WHEN {follow_up} < 0 THEN 0 ELSE {follow_up} END",
    }
    return sql_columns({name: f"cast({sql} AS BIGINT)" for name, sql in spans.items()})


def finish_journey(rows: DataFrame, params: Params) -> DataFrame:
    """Derived journey columns of rows that hold every input of one patient."""
    first = {
        "referral_completed_flag": "first_oncology_date IS NOT NULL",
        "referral_delay_days": "cast(datediff(first_oncology_date, first_urology_date) AS BIGINT)",
        "discontinued_within_12m": "coalesce(discontinuation_flag AND "
        "datediff(discontinuation_date, treatment_start_date) <= 365, false)",
        "final_outcome_status": "outcome_status",
        "synthetic_data_flag": "true",
    }
    return (
        rows.withColumns({**sql_columns(first), **initiation_columns(params), **elapsed_columns()})
        .withColumns(persistence_columns(params))
        .select(*JOURNEY_COLUMNS)
    )


PERSON_COLUMNS = (
    "patient_id", "age_at_index", "comorbidity_score", "frailty_proxy", "region",
    "insurance_type", "synthetic_scenario_version",
)
DISEASE_COLUMNS = (
    "patient_id", "prostate_stage", "metastatic_flag", "hormone_sensitive_flag",
    "castration_resistant_flag",
)


def initial_provider(assignment: DataFrame) -> DataFrame:
    return assignment.select(
        "patient_id",
        F.col("care_setting").alias("initial_care_setting"),
        F.col("provider_specialty").alias("initial_provider_specialty"),
        "multidisciplinary_team_flag",
    )


def build_patient_journey(
    patient: DataFrame, diagnosis: DataFrame, assignment: DataFrame, eligibility: DataFrame,
    encounter: DataFrame, treatment: DataFrame, outcome: DataFrame, params: Params,
) -> DataFrame:
    """The journey from finished tables: one row per patient with a diagnosis and eligibility.

    Every input is joined on patient_id after reduction to one row per patient,
    so the joins share one distribution.
    """
    visits = first_events(
        encounter,
        {"urology_follow_up": "first_urology_date", "oncology_consultation": "first_oncology_date"},
        kind="encounter_type",
        date="encounter_date",
    )
    rows = (
        patient.select(*PERSON_COLUMNS)
        .join(diagnosis.select(*DISEASE_COLUMNS), "patient_id")
        .join(eligibility.drop("synthetic_contraindication_flag"), "patient_id")
        .join(visits, "patient_id", "left")
        .join(first_treatment(treatment), "patient_id", "left")
        .join(outcome, "patient_id", "left")
        .join(initial_provider(assignment), "patient_id", "left")
    )
    return finish_journey(rows, params)


def model_ready_features(journey: DataFrame, as_of: str | None = None) -> DataFrame:
    """Baseline feature columns and the 90-day gap label.

    The referral delay may be observed after the index date. With ``as_of``, a
    date column of the journey, a delay not yet known on that day is null.
    """
    if as_of is not None:
        known = F.col("first_oncology_date") <= F.col(as_of)
        journey = journey.withColumn("referral_delay_days", F.when(known, F.col("referral_delay_days")))
    return journey.select(*FEATURE_COLUMNS)
