"""Outcome dates, censoring and the final status of each patient."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sojourn.functions.expr import keep_until, sql_columns, truth
from sojourn.operators.pathway import attach_first_dates
from sojourn.params import Params

#: Clinical event type -> column holding its first date on or after index.
CLINICAL_DATES = {
    "progression": "progression_date",
    "castration_resistant": "castration_resistant_date",
    "hospitalisation": "first_hospitalisation_date",
    "adverse_event": "adverse_event_date",
    "death": "death_date",
}


def with_clinical_dates(
    index: DataFrame, events: DataFrame, params: Params, index_date: str = "eligibility_date"
) -> DataFrame:
    """Add the first date of each clinical event on or after index, and the adverse event type.

    Dates past the end of observation become null.
    """
    end = F.lit(params.observation_end_date)
    dated = attach_first_dates(
        index, events, index_date, CLINICAL_DATES, {"adverse_event": "adverse_event_type"}
    )
    return dated.withColumns({c: keep_until(F.col(c), end) for c in CLINICAL_DATES.values()})


def follow_up(death: Column, last_activity: Column, params: Params) -> dict[str, Column]:
    """Loss to follow-up, last observed day and censor date from death and last activity."""
    end = F.lit(params.observation_end_date)
    silent = F.date_add(last_activity, params.loss_to_follow_up_days) < end
    lost = truth(death.isNull() & silent)
    observed = F.when(lost, last_activity).otherwise(end)
    return {
        "lost_to_follow_up_flag": lost,
        "last_observed_date": observed,
        "censor_date": F.least(end, death, observed),
    }


#: First state that applies, most final first; null flags do not apply.
OUTCOME_STATUS = """CASE
    WHEN death_flag THEN 'deceased'
    WHEN lost_to_follow_up_flag THEN 'lost_to_follow_up'
    WHEN progression_event THEN 'progressed'
    WHEN restart_flag THEN 'restarted'
    WHEN switch_flag THEN 'switched'
    WHEN discontinuation_flag THEN 'discontinued'
    WHEN last_activity_date IS NOT NULL THEN 'active_treatment'
    ELSE 'censored' END"""


#: Columns in the order of the table.
OUTCOME_COLUMNS = (
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
    "outcome_status",
)


def with_outcome(rows: DataFrame, params: Params) -> DataFrame:
    """Outcome columns of rows holding mhspc_flag, clinical dates, last activity and first-treatment flags."""
    transition = "coalesce(mhspc_flag AND castration_resistant_date >= progression_date, false)"
    columns = {
        "progression_event": "progression_date IS NOT NULL",
        "castration_resistant_transition": transition,
        "castration_resistant_date": f"CASE WHEN {transition} THEN castration_resistant_date END",
        "hospitalisation_flag": "first_hospitalisation_date IS NOT NULL",
        "adverse_event_flag": "adverse_event_date IS NOT NULL",
        "adverse_event_type": "CASE WHEN adverse_event_date IS NOT NULL THEN adverse_event_type END",
        "death_flag": "death_date IS NOT NULL",
    }
    followed = rows.withColumns(
        {**sql_columns(columns), **follow_up(F.col("death_date"), F.col("last_activity_date"), params)}
    )
    return followed.withColumn("outcome_status", F.expr(OUTCOME_STATUS))


def derive_outcome(spine: DataFrame, treated: DataFrame, params: Params) -> DataFrame:
    """One outcome row per patient.

    ``spine`` has one row per patient with mhspc_flag, the clinical dates and
    adverse_event_type; ``treated`` has one row per treated patient with
    last_activity_date and the flags of the first treatment.
    """
    rows = with_outcome(spine.join(treated, "patient_id", "left"), params)
    return rows.select("patient_id", *OUTCOME_COLUMNS)
