"""Lenient intake of raw CSV folders: nothing fails, and what cannot be used goes to a quarantine with the reason.

Rows are read as text, permissively: a record with too few or too many fields is kept as it stands. Each
record is then held against a contract, in order, and the first thing wrong with it is its reason.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sojourn.functions.expr import resolve
from sojourn.operators.cohort import normalize_patients, publish_keys, select_cohort
from sojourn.operators.sampling import sample_to_size
from sojourn.params import Params
from sojourn.sources.files import csv_paths

RECORD = "_record"

#: Columns of the raw patient table that must hold a date where they hold anything.
DATES = ("BIRTHDATE", "DEATHDATE")
KEYS = ("Id", "patient_id")


@dataclass(frozen=True)
class Intake:
    """Rows that meet the contract, with the columns of the file, and the records that do not."""

    accepted: DataFrame
    quarantined: DataFrame


def scan_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every record of a CSV table as text by header name, and the whole line of a malformed one."""
    reader = spark.read.option("header", True)
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, RECORD]])
    # Pruned columns would not be parsed, and a record's number of fields would go unseen.
    return reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD).option("columnPruning", False).csv(path)


def _given(df: DataFrame, name: str) -> bool:
    return name.lower() in {column.lower() for column in df.columns}


def patient_contract(df: DataFrame) -> dict[str, Column]:
    """What makes a raw patient record unusable, by reason."""
    broken = {"malformed record": F.col(RECORD).isNotNull()}
    key = F.trim(resolve(df, KEYS))
    broken["no key"] = key.isNull() | (key == "")
    for name in DATES:
        if _given(df, name):
            text = resolve(df, [name])
            broken[f"{name} is not a date"] = text.isNotNull() & F.try_to_date(text).isNull()
    return broken


def take_in(scanned: DataFrame, contract: Mapping[str, Column], table: str) -> Intake:
    """Part the records of a scanned table by its contract. A quarantined record keeps its line, its key and one reason."""
    reason = F.lit(None).cast("string")
    for name, condition in reversed(contract.items()):
        reason = F.when(condition, F.lit(name)).otherwise(reason)
    judged = scanned.withColumn("_reason", reason)
    columns = [c for c in scanned.columns if c != RECORD]
    line = F.coalesce(F.col(RECORD), F.array_join(F.array(*[F.col(f"`{c}`") for c in columns]), ",", ""))
    quarantined = judged.filter(F.col("_reason").isNotNull()).select(
        F.lit(table).alias("table_name"), resolve(scanned, KEYS).alias("record_key"), F.col("_reason").alias("reason"), line.alias("record")
    )
    return Intake(judged.filter(F.col("_reason").isNull()).drop("_reason", RECORD), quarantined)


def patient_intake(spark: SparkSession, directory: str) -> Intake | None:
    """The raw patients of a CSV folder, or None where the folder has no patient table."""
    path = csv_paths(spark, directory).get("patients")
    if path is None:
        return None
    scanned = scan_csv(spark, path)
    return take_in(scanned, patient_contract(scanned), "patients")


def cohort_from_csv(spark: SparkSession, directory: str, params: Params) -> DataFrame:
    """The normalised cohort of a raw CSV folder, exactly ``target_cohort_size`` rows, with published keys.

    More eligible patients than wanted are sampled, fewer are drawn with replacement, each draw a patient of its own;
    none at all, or no patient table, is an error, as there is nothing to draw from.
    """
    intake = patient_intake(spark, directory)
    if intake is None:
        raise FileNotFoundError(f"{directory} holds no patients.csv")
    selected = select_cohort(intake.accepted, params)
    key = next(c for c in selected.columns if c.lower() in {k.lower() for k in KEYS})
    sized = sample_to_size(selected, key, params.target_cohort_size, params.random_seed)
    if sized.isEmpty():
        raise ValueError(f"no patient of {directory} is eligible")
    return publish_keys(normalize_patients(sized, params, draw="draw"))
