"""Build the seven tables, check them, and publish only what passes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sojourn.operators.cohort import attach_death_date, publish_keys
from sojourn.operators.eligibility import build_eligibility, eligibility_columns
from sojourn.operators.episodes import (
    build_treatments,
    episodes_of_days,
    fill_days,
    treated_patients,
    treatment_columns,
    treatment_episodes,
    treatment_history,
    with_course,
    with_neighbours,
    with_prescriber,
)
from sojourn.operators.outcomes import OUTCOME_COLUMNS, derive_outcome, with_clinical_dates, with_outcome
from sojourn.operators.pathway import build_encounters, referral_pathway, with_visited_provider
from sojourn.params import TABLES, Params
from sojourn.plans.quality import gate as verdict
from sojourn.plans.quality import raise_on_critical, row_measures, validate_tables
from sojourn.plans.serving import kpis, missingness, range_fingerprints, roll_up, value_counts
from sojourn.plans.timeline import (
    DISEASE_COLUMNS,
    FIRST_TREATMENT,
    INITIAL,
    PERSON_COLUMNS,
    build_patient_journey,
    finish_journey,
    initial_provider,
)
from sojourn.sources import versions
from sojourn.sources.files import (
    bucket_table,
    export_tables,
    load_exported_tables,
    new_stage,
    save_bucketed,
    spread,
    stage_table,
    stage_tables,
    task_count,
    write_csv_table,
)


@dataclass(frozen=True)
class Observed:
    """Observed inputs of one scenario, all keyed by the same patient_id.

    patient: normalised rows plus ``contraindication_flag``; diagnosis: one
    staged record per patient; provider: the network; assignment: one provider
    row per patient; visits: (patient_id, event_type, event_date);
    clinical: the same with ``event_detail``; fills: dispensing records.
    """

    patient: DataFrame
    diagnosis: DataFrame
    provider: DataFrame
    assignment: DataFrame
    visits: DataFrame
    clinical: DataFrame
    fills: DataFrame
    source_visit: str = "urology_follow_up"
    target_visit: str = "oncology_consultation"
    days = None


@dataclass(frozen=True)
class FoldedInputs(Observed):
    """Observed inputs with their fills folded by ``fill_days`` before."""

    days: DataFrame | None = None


def staged_inputs(observed: Observed, params: Params, stage: str) -> FoldedInputs:
    """What several runs read of the same inputs, staged once; the fills as days. Patients and providers stay as they are."""
    plans = {
        "_days": fill_days(observed.fills, params), "_diagnosis": observed.diagnosis, "_assignment": observed.assignment,
        "_clinical": observed.clinical, "_visits": observed.visits,
    }
    known = {field.name: getattr(observed, field.name) for field in fields(observed)}
    return FoldedInputs(**known | {name[1:]: table for name, table in stage_tables(plans, stage).items()})


def observed_pathway(observed: Observed) -> DataFrame:
    return referral_pathway(observed.visits, observed.source_visit, observed.target_visit)


def encounter_rows(diagnosis: DataFrame, pathway: DataFrame) -> DataFrame:
    dated = diagnosis.select("patient_id", "diagnosis_date")
    return build_encounters(
        dated.join(pathway.select("patient_id", "source_date", "target_date"), "patient_id", "left")
    )


#: The index date is the latest of these.
INDEX_DATES = ("diagnosis_date", "metastatic_date", "hormone_sensitive_confirmation_date")


def _first_episodes(observed: Observed, params: Params, days: DataFrame | None = None) -> DataFrame:
    """Each patient's first episode with what follows it; ``days`` are fills folded before."""
    index = observed.diagnosis.select("patient_id", F.greatest(*INDEX_DATES).alias("eligibility_date"))
    if days is None:
        episodes = treatment_episodes(observed.fills, index, params, "eligibility_date")
    else:
        episodes = episodes_of_days(days, index, params, "eligibility_date")
    return with_neighbours(episodes).filter(F.col("episode_no") == 1)


def observed_outcome(observed: Observed, params: Params, days: DataFrame | None = None) -> DataFrame:
    """The outcome table straight from observed inputs, in one plan.

    Clinical events and fills are read once each: stops and restarts of the first episode are found on the
    row that carries the clinical dates. ``days`` are fills folded before, if other results share them.
    """
    judged = build_eligibility(observed.patient, observed.diagnosis, params)
    index = judged.select("patient_id", "mhspc_flag", "eligibility_date")
    dated = with_clinical_dates(index, observed.clinical, params)
    rows = dated.join(_first_episodes(observed, params, days), "patient_id", "left")
    treated = with_course(rows, params).withColumn("switch_flag", F.col("has_other_drug"))
    return with_outcome(treated, params).select("patient_id", *OUTCOME_COLUMNS)


def observed_journey(observed: Observed, params: Params) -> DataFrame:
    """The journey straight from observed inputs, in one plan.

    Equals building every table and joining them, but the fills are read once
    and reduced to each patient's first episode before anything else is
    joined, and all later steps are projections over one row per patient.
    """
    disease = observed.diagnosis
    first = _first_episodes(observed, params)
    pathway = observed_pathway(observed)
    base = (
        observed.patient.select(*PERSON_COLUMNS, "contraindication_flag")
        .join(disease.select(*DISEASE_COLUMNS, "prostate_cancer_flag", *INDEX_DATES), "patient_id")
        .withColumns(eligibility_columns(params))
    )
    rows = (
        with_clinical_dates(base, observed.clinical, params)
        .join(first, "patient_id", "left")
        .join(
            pathway.select(
                "patient_id",
                F.col("source_date").alias("first_urology_date"),
                F.col("target_date").alias("first_oncology_date"),
            ),
            "patient_id",
            "left",
        )
        .join(initial_provider(observed.assignment), "patient_id", "left")
    )
    treated = with_course(rows, params).withColumns(
        {
            name: F.when(F.col("episode_no").isNotNull(), column)
            for name, column in treatment_columns(params).items()
            if name in FIRST_TREATMENT
        }
    )
    return finish_journey(with_outcome(treated.withColumnsRenamed(INITIAL), params), params)


def build_tables(
    observed: Observed, params: Params, stage: str, work: str | None = None,
    form: Callable[[DataFrame], DataFrame] = lambda table: table, measured: dict[str, int] | None = None,
    save: Callable[[DataFrame, str, str], DataFrame] = stage_table,
) -> dict[str, DataFrame]:
    """Write the seven tables to a stage folder, each once; what several of them need is staged once, too.

    ``work`` takes what is only needed on the way, if that is another folder. ``form`` is how tables are
    written, such as with published keys; what is read back to make further tables is in that form as well.
    ``measured`` receives the failure counts of all row rules, taken as soon as a table is written.
    ``save`` writes the tables themselves, if other than by ``stage_table``; with it, ``work`` should be given.
    """
    apart = work is not None and work != stage

    def kept(df: DataFrame, directory: str, name: str) -> DataFrame:
        return (stage_table if name.startswith("_") else save)(df, directory, name)

    def staged(plans: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        place = lambda name: work if apart and name.startswith("_") else stage
        measures = {} if measured is None else {name: row_measures(name, df, params) for name, df in plans.items()}
        return stage_tables(plans, place, measures, measured, kept)

    roots = staged({"_diagnosis": observed.diagnosis, "_assignment": observed.assignment, "provider": observed.provider})
    diagnosis, assignment, provider = roots.values()
    days = None if observed.days is None else spread(observed.days, "patient_id")
    judged = build_eligibility(observed.patient, diagnosis, params)
    spine = staged({"_spine": with_clinical_dates(judged, observed.clinical, params)})["_spine"]
    visited = encounter_rows(diagnosis, observed_pathway(observed))
    published = diagnosis.drop("hormone_sensitive_confirmation_date")
    events = staged(
        {
            "_history": treatment_history(observed.fills, spine, params, days=days),
            "encounter": form(with_visited_provider(visited, assignment)),
            **({"diagnosis": form(published)} if apart else {}),
        }
    )
    courses = staged(
        {
            "treatment": form(with_prescriber(build_treatments(events["_history"], params), provider)),
            "outcome": form(derive_outcome(spine, treated_patients(events["_history"]), params)),
        }
    )
    treatment, outcome = courses.values()
    person = form(observed.patient.drop("contraindication_flag"))
    final = staged(
        {
            "patient": attach_death_date(person, outcome),
            "patient_journey": build_patient_journey(
                person, form(diagnosis), form(assignment), form(spine.select(*judged.columns)),
                events["encounter"], treatment, outcome, params,
            ),
        }
    )
    return {
        "patient": final["patient"],
        "diagnosis": events.get("diagnosis", published),
        "provider": provider,
        "encounter": events["encounter"],
        "treatment": treatment,
        "outcome": outcome,
        "patient_journey": final["patient_journey"],
    }


def write_quality_report(results: DataFrame, directory: str) -> None:
    """Rule results as JSON and CSV, and the verdict; a few dozen rows, so one file each."""
    small = results.coalesce(1)
    verdict(results).coalesce(1).write.mode("overwrite").json(f"{directory}/data_quality_verdict.json")
    small.write.mode("overwrite").json(f"{directory}/data_quality_summary.json")
    write_csv_table(small, f"{directory}/data_quality_summary.csv")


def write_cohort_report(journey: DataFrame, params: Params, directory: str) -> None:
    """KPIs, segment counts and missingness as CSV; all small by construction."""
    write_csv_table(kpis(journey, params).coalesce(1), f"{directory}/cohort_kpis.csv")
    write_csv_table(value_counts(journey).coalesce(1), f"{directory}/cohort_value_counts.csv")
    write_csv_table(missingness(journey).coalesce(1), f"{directory}/cohort_missingness.csv")


#: Key that deals a published table's rows to the ranges of its digest tree.
RANGE_KEY = {name: "provider_id" if name == "provider" else "patient_id" for name in TABLES}


def fingerprint_leaves(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count and hash of every key range of every table, all columns in the order of their names."""
    leaves: DataFrame | None = None
    for name, df in tables.items():
        rows = range_fingerprints(df, RANGE_KEY.get(name, df.columns[0]), sorted(df.columns))
        rows = rows.select(F.lit(name).alias("table_name"), "key_range", "n_rows", "fingerprint", "fingerprint_low")
        leaves = rows if leaves is None else leaves.unionByName(rows)
    if leaves is None:
        raise ValueError("fingerprints need at least one table")
    return leaves


def fingerprints(leaves: DataFrame, names: Iterable[str] = TABLES) -> DataFrame:
    """Row count and hash per table, rolled up from its key ranges; a table without rows has none of either."""
    listed = F.explode(F.array(*[F.lit(name) for name in names])).alias("table_name")
    every = leaves.sparkSession.range(1).select(listed)
    numbers = ("n_rows", "fingerprint", "fingerprint_low")
    rolled = every.join(roll_up(leaves, "table_name"), "table_name", "left")
    return rolled.select("table_name", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in numbers])


def write_fingerprints(tables: Mapping[str, DataFrame], directory: str) -> None:
    """Leaves and roots of the digest trees of tables as they were written; at most 256 small rows a table."""
    leaves = stage_table(fingerprint_leaves(tables).coalesce(1), directory, "fingerprint_ranges")
    write_csv_table(fingerprints(leaves, tables).coalesce(1), f"{directory}/output_fingerprints.csv")


def audit(
    tables: Mapping[str, DataFrame], params: Params, stage: str, measured: Mapping[str, int] | None = None
) -> DataFrame:
    """Rule results over the tables, staged so that they are computed once."""
    return stage_table(validate_tables(tables, params, measured=measured), stage, "_quality")


def publish(
    spark: SparkSession, observed: Observed, params: Params, gold: str,
    formats: Iterable[str] = ("parquet",), gate: Callable[[DataFrame], None] = raise_on_critical,
) -> str:
    """Write, audit, publish. Returns the run folder that readers now see.

    Tables are written once, as Parquet with published keys, to a run folder of their own; the audit and
    the fingerprints read those files, and other formats are copied from them. Only when no critical
    rule fails is the run promoted to the next version of ``gold``. A failed run raises and leaves the
    published version untouched, and so does a run that another publisher overtook. ``gate`` decides
    from the rule results and raises to hold the run back.
    """
    seen, work = versions.latest(spark, gold), new_stage(spark)
    run = f"{gold}/runs/{uuid.uuid4().hex}"
    try:
        measured: dict[str, int] = {}
        tables = build_tables(observed, params, run, work, publish_keys, measured)
        results = audit(tables, params, work, measured)
        write_quality_report(results, f"{run}/reports")
        gate(results)
        export_tables(tables, run, [kind for kind in formats if kind != "parquet"])
        write_fingerprints(tables, f"{run}/reports")
        write_cohort_report(tables["patient_journey"], params, f"{run}/reports")
        versions.promote(spark, gold, seen, run)
    finally:
        versions.remove_folder(spark, work)
    return run


RULE_RESULT = "rule string, severity string, status string, failure_count bigint, detail string"


def load_quality_reports(spark: SparkSession, gold: str) -> DataFrame:
    """Rule results of every run in ``gold``, held back or not."""
    return spark.read.schema(RULE_RESULT).json(f"{gold}/runs/*/reports/data_quality_summary.json")


def has_published(spark: SparkSession, gold: str) -> bool:
    """Whether readers of ``gold`` see any run."""
    return versions.latest(spark, gold) > 0


def published_run(spark: SparkSession, gold: str) -> str:
    """Folder of the run promoted last."""
    number = versions.latest(spark, gold)
    if not number:
        raise FileNotFoundError(f"nothing is published in {gold}")
    return versions.run_of(spark, gold, number)


def bucket_tables(spark: SparkSession, tables: Mapping[str, DataFrame], directory: str, buckets: int | None = None) -> dict[str, DataFrame]:
    """The tables saved for SQL, laid out for the joins: by patient, the provider table by provider."""
    return save_bucketed(spark, tables, directory, RANGE_KEY, buckets)


def build_bucketed(observed: Observed, params: Params, stage: str) -> dict[str, DataFrame]:
    """The seven tables written once, at once in buckets for SQL, see ``bucket_tables``.

    There are as many buckets as tasks that deal the fills, so that a bucket does not grow with the input.
    """
    buckets = task_count(observed.fills)

    def save(df: DataFrame, directory: str, name: str) -> DataFrame:
        return bucket_table(df, directory, name, RANGE_KEY[name], buckets)

    return build_tables(observed, params, f"{stage}/bucketed", f"{stage}/work", save=save)


def load_published(
    spark: SparkSession, gold: str, names: Iterable[str] = TABLES
) -> dict[str, DataFrame]:
    """The seven tables of the run published last."""
    return load_exported_tables(spark, published_run(spark, gold), names)


LEAVES = "table_name string, key_range string, n_rows bigint, fingerprint bigint, fingerprint_low bigint"
KPIS = "kpi string, value bigint, data_label string"


def load_fingerprint_leaves(spark: SparkSession, run: str) -> DataFrame:
    return spark.read.schema(LEAVES).parquet(f"{run}/reports/fingerprint_ranges.parquet")


def load_kpi_report(spark: SparkSession, run: str) -> DataFrame:
    """The KPI report of a run, as it was written."""
    return spark.read.schema(KPIS).option("header", True).csv(f"{run}/reports/cohort_kpis.csv")
