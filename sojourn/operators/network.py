"""Shape of the provider network."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROVIDERS_PER_ORGANIZATION = 3


def organization_number(index: Column) -> Column:
    """Consecutive providers share an organisation."""
    return F.floor(index / PROVIDERS_PER_ORGANIZATION).cast("bigint")


def academic_flag(care_setting: Column) -> Column:
    return F.coalesce(care_setting == "academic_oncology", F.lit(False))


def organization_rollup(provider: DataFrame) -> DataFrame:
    """One row per organisation: providers, academic providers, annual volume."""
    return provider.groupBy("organization_id").agg(
        F.count(F.lit(1)).alias("n_providers"),
        F.count_if("academic_flag").alias("n_academic"),
        F.count_if("multidisciplinary_team_flag").alias("n_multidisciplinary"),
        F.sum("annual_prostate_volume").alias("annual_volume"),
    )


def distinct_regions(patient: DataFrame) -> DataFrame:
    return patient.select("region").filter(F.col("region").isNotNull()).distinct().orderBy("region")
