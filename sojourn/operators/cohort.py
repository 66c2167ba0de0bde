"""Cohort selection and the normalised patient table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sojourn.functions.expr import floored_age, lenient_date, resolve, rounded_age, surrogate_key
from sojourn.params import Params


def select_cohort(raw: DataFrame, params: Params) -> DataFrame:
    """Men whose floored age at the index date lies in the configured range."""
    sex = F.upper(resolve(raw, ["GENDER"]).cast("string"))
    birth = lenient_date(raw, resolve(raw, ["BIRTHDATE"]))
    age = floored_age(F.lit(params.index_date), birth)
    return raw.filter(
        sex.isin("M", "MALE") & age.between(params.minimum_age, params.maximum_age)
    ).withColumn("synthetic_index_date", F.lit(params.index_date))


def normalize_patients(
    raw: DataFrame, params: Params, draw: str | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """Normalised patient rows with sampling metadata.

    Header case is ignored and absent columns take defaults. ``patient_id`` is
    the source key, or ``draw`` for an oversampled cohort where one source
    patient stands for several rows. Joins run on that natural key;
    ``publish_keys`` formats it once, on the way out. Attributes the source
    does not carry stay null. ``carry`` keeps extra source columns.
    """
    source_id = resolve(raw, ["Id", "patient_id"])
    birth = lenient_date(raw, resolve(raw, ["BIRTHDATE"]))
    index = resolve(raw, ["synthetic_index_date"], F.lit(params.index_date)).cast("date")
    number = source_id if draw is None else F.coalesce(F.col(draw).cast("string"), source_id.cast("string"))
    return raw.select(
        number.alias("patient_id"),
        source_id.cast("string").alias("synthea_patient_id"),
        birth.alias("birth_date"),
        F.year(birth).alias("birth_year"),
        rounded_age(index, birth).alias("age_at_index"),
        F.lit("male").alias("sex"),
        F.lit("US").alias("country"),
        resolve(raw, ["STATE"]).cast("string").alias("region"),
        F.substring(resolve(raw, ["ZIP"]).cast("string"), 1, 3).alias("postal_code_prefix"),
        F.lower(resolve(raw, ["RACE"]).cast("string")).alias("race"),
        F.lower(resolve(raw, ["ETHNICITY"], F.lit("nonhispanic")).cast("string")).alias("ethnicity"),
        resolve(raw, ["insurance_type"]).cast("string").alias("insurance_type"),
        resolve(raw, ["comorbidity_score"]).cast("int").alias("comorbidity_score"),
        resolve(raw, ["frailty_proxy"]).cast("double").alias("frailty_proxy"),
        resolve(raw, ["socioeconomic_proxy"]).cast("string").alias("socioeconomic_proxy"),
        F.lit(None).cast("date").alias("date_of_death"),
        F.lit(True).alias("synthetic_oversampling_flag"),
        F.lit(False).alias("population_representative_flag"),
        F.lit(1.0).alias("sampling_weight"),
        F.lit(params.scenario_version).alias("synthetic_scenario_version"),
        *carry,
    )


def attach_death_date(patient: DataFrame, outcome: DataFrame) -> DataFrame:
    """Fill ``date_of_death`` on the patient from the outcome table."""
    deaths = outcome.select("patient_id", F.col("death_date").alias("_death"))
    return (
        patient.join(deaths, "patient_id", "left")
        .withColumn("date_of_death", F.col("_death"))
        .drop("_death")
    )


def publish_keys(table: DataFrame) -> DataFrame:
    """Published form ``PJ-00000042`` of the patient key, a projection without a shuffle."""
    if "patient_id" not in table.columns:
        return table
    return table.withColumn("patient_id", surrogate_key("PJ", F.col("patient_id")))
