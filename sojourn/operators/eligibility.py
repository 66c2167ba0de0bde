"""Stage flags, the disease-state rule and treatment eligibility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sojourn.functions.expr import clamp, days_between, truth
from sojourn.params import Params


def flag_stage(diagnosis: DataFrame) -> DataFrame:
    """Stage indicators, confirmation date and grade group from a raw diagnosis record.

    Needs ``prostate_stage``, ``diagnosis_date``, ``metastatic_date`` and ``gleason_score``.
    """
    stage = F.col("prostate_stage")
    metastatic = truth(stage == "metastatic")
    return diagnosis.withColumns(
        {
            "localized_flag": truth(stage == "localized"),
            "locally_advanced_flag": truth(stage == "locally_advanced"),
            "metastatic_flag": metastatic,
            "metastatic_date": F.when(metastatic, F.col("metastatic_date")),
            "hormone_sensitive_confirmation_date": F.when(
                metastatic, F.col("metastatic_date")
            ).otherwise(F.col("diagnosis_date")),
            "isup_grade_group": clamp(F.col("gleason_score") - 5, 1, 5).cast("bigint"),
        }
    )


def mhspc() -> Column:
    """Metastatic hormone-sensitive disease at index."""
    return truth(
        F.col("prostate_cancer_flag")
        & F.col("metastatic_flag")
        & F.col("hormone_sensitive_flag")
        & ~F.col("castration_resistant_flag")
    )


def derive_mhspc(diagnosis: DataFrame) -> DataFrame:
    return diagnosis.withColumn("mhspc_flag", mhspc())


def eligibility_columns(params: Params) -> dict[str, Column]:
    """Eligibility of one row holding a patient's and its diagnosis's attributes.

    The eligibility date is the latest known of diagnosis, metastasis and confirmation.
    """
    date = F.greatest("diagnosis_date", "metastatic_date", "hormone_sensitive_confirmation_date")
    possible = days_between(F.lit(params.observation_end_date), date)
    contraindicated = truth(F.col("contraindication_flag"))
    eligible = (
        mhspc()
        & (F.col("age_at_index") >= 18)
        & ~contraindicated
        & (possible >= params.minimum_follow_up_days)
    )
    return {
        "mhspc_flag": mhspc(),
        "eligibility_date": date,
        "synthetic_contraindication_flag": contraindicated,
        "eligible_for_arpi": truth(eligible),
        "eligibility_rule_version": F.lit(params.eligibility_rule_version),
    }


def build_eligibility(patient: DataFrame, diagnosis: DataFrame, params: Params) -> DataFrame:
    """One eligibility row per patient with a diagnosis.

    ``patient`` brings ``age_at_index`` and ``contraindication_flag``.
    """
    person = patient.select("patient_id", "age_at_index", "contraindication_flag")
    columns = eligibility_columns(params)
    return person.join(diagnosis, "patient_id").select(
        "patient_id", *[column.alias(name) for name, column in columns.items()]
    )
