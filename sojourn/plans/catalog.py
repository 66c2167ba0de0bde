"""Every operator and view as a named query over the bound tables."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sojourn.functions.expr import weighted_bucket
from sojourn.operators import cohort, eligibility, episodes, keys, network, pathway, sampling
from sojourn.operators.lines import lines_of_therapy
from sojourn.operators.outcomes import with_clinical_dates
from sojourn.plans import publish, quality, serving, timeline
from sojourn.sources import files, intake, roles
from sojourn.sources.roles import BOUND

Query = Callable[[SparkSession, str], DataFrame]


def journey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.observed_journey(roles.observed(spark, sf_dir), BOUND)


def journey_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same journey joined from finished tables, each staged once."""
    tables = publish.build_tables(roles.observed(spark, sf_dir), BOUND, files.new_stage(spark))
    return tables["patient_journey"]


def _over_journey(view: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: view(journey(spark, sf_dir))


def _journey_columns(*columns: str) -> Query:
    return lambda spark, sf_dir: journey(spark, sf_dir).select("patient_id", *columns)


def _eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligibility.build_eligibility(
        roles.patients(spark, sf_dir), roles.diagnoses(spark, sf_dir), BOUND
    )


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eligibility date per patient, from the diagnosis alone."""
    date = F.greatest("diagnosis_date", "metastatic_date", "hormone_sensitive_confirmation_date")
    return roles.diagnoses(spark, sf_dir).select("patient_id", date.alias("index_date"))


def _spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _eligibility(spark, sf_dir).select("patient_id", "mhspc_flag", "eligibility_date")
    return with_clinical_dates(index, roles.clinical_events(spark, sf_dir), BOUND)


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return episodes.treatment_history(roles.fills(spark, sf_dir), _spine(spark, sf_dir), BOUND)


def cohort_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    selected = cohort.select_cohort(roles.raw_patients(spark, sf_dir), BOUND)
    return selected.select("Id", "BIRTHDATE", "GENDER", "STATE", "ZIP", "synthetic_index_date")


def cohort_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.publish_keys(
        cohort.normalize_patients(roles.raw_patients(spark, sf_dir), BOUND)
    )


def lenient_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = roles.read(spark, sf_dir, "orders")
    dated = F.col("o_orderdate").cast("date").cast("string")
    text = F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).otherwise(dated)
    parsed = F.try_to_date(text)
    return orders.select("o_orderkey", parsed.alias("parsed_date"), parsed.isNotNull().alias("parsed"))


def stage_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.diagnoses(spark, sf_dir).select(
        "patient_id", "prostate_stage", "diagnosis_date", "metastatic_date", "localized_flag",
        "locally_advanced_flag", "metastatic_flag", "hormone_sensitive_confirmation_date",
        "gleason_score", "isup_grade_group",
    )


def class_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classed = episodes.with_drug_class(roles.fills(spark, sf_dir))
    named = classed.withColumn("regimen_name", episodes.regimen_name())
    return named.groupBy("drug_name", "drug_class", "regimen_name").agg(
        F.count(F.lit(1)).alias("n_fills")
    )


def first_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = roles.read(spark, sf_dir, "events").select(
        F.col("user_id").alias("patient_id"), "event_type", F.col("ts").cast("date").alias("event_date")
    )
    wanted = {
        "signup": "first_signup_date",
        "purchase": "first_purchase_date",
        "error": "first_error_date",
    }
    return pathway.first_events(events, wanted)


def first_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.index_records(spark, sf_dir)


def last_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    treatment = episodes.build_treatments(_history(spark, sf_dir), BOUND)
    return pathway.last_event(treatment, ("treatment_end_date", "restart_date", "switch_date"))


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = pathway.event_log(
        {
            "diagnosis": (roles.diagnoses(spark, sf_dir), "patient_id", "diagnosis_date"),
            "fill": (roles.fills(spark, sf_dir), "patient_id", "fill_date"),
            "visit": (roles.read(spark, sf_dir, "events"), "user_id", "ts"),
        }
    )
    key = ("patient_id", "event_type", "event_date")
    return files.spread(log, *key).groupBy(*key).agg(F.count(F.lit(1)).alias("n_events"))


def encounter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = publish.encounter_rows(roles.diagnoses(spark, sf_dir), referral_pathway(spark, sf_dir))
    return pathway.with_visited_provider(rows, roles.assignments(spark, sf_dir))


def referral_pathway(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pathway.referral_pathway(
        roles.visits(spark, sf_dir), "urology_follow_up", "oncology_consultation"
    )


def treatment_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return episodes.treatment_episodes(roles.fills(spark, sf_dir), _index(spark, sf_dir), BOUND)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of_therapy(roles.fills(spark, sf_dir), _index(spark, sf_dir), BOUND)


def discontinuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir).select(
        "patient_id", "episode_no", "covered_until_date", "censor_date", "has_other_drug",
        "discontinuation_flag", "discontinuation_date",
    )


def restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir).select(
        "patient_id", "episode_no", "drug_class", "discontinuation_flag", "restart_flag",
        "restart_date", "temporary_gap_flag",
    )


def refill_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return episodes.refill_calendar(treatment_episodes(spark, sf_dir), BOUND)


def treatment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = episodes.build_treatments(_history(spark, sf_dir), BOUND)
    return episodes.with_prescriber(rows, roles.providers(spark, sf_dir))


def outcome_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.observed_outcome(roles.observed(spark, sf_dir), BOUND)


def top_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.top_segments(serving.treatment_gap_by_segment(journey(spark, sf_dir)))


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage the tables, then run the rules over what was written."""
    measured: dict[str, int] = {}
    tables = publish.build_tables(roles.observed(spark, sf_dir), BOUND, files.new_stage(spark), measured=measured)
    return quality.validate_tables(tables, BOUND, measured=measured)


def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gate(_audit(spark, sf_dir))


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.duplicate_keys(roles.read(spark, sf_dir, "lineitem"), ("l_orderkey", "l_linenumber"))


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event users spread over a wider key range, so that some have no customer."""
    events = roles.read(spark, sf_dir, "events").select((F.col("user_id") * 31).alias("user_key"))
    return keys.orphans(events, "user_key", roles.read(spark, sf_dir, "customer"), "c_custkey")


def coverage_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.coverage_gap(
        roles.read(spark, sf_dir, "customer"), "c_custkey", roles.read(spark, sf_dir, "events"), "user_id"
    )


def after_terminal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fills after censoring. Fills are folded to days once, for the outcome and for what is checked against it."""
    observed = roles.observed(spark, sf_dir)
    days = files.stage_table(episodes.fill_days(observed.fills, BOUND), files.new_stage(spark), "_fill_days")
    outcome = publish.observed_outcome(observed, BOUND, days)
    return keys.after_terminal(days, "fill_date", outcome, "censor_date", counted="n_fills")


def distinct_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.distinct_regions(roles.patients(spark, sf_dir))


def org_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.organization_rollup(roles.providers(spark, sf_dir))


def sample_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    selected = cohort.select_cohort(roles.raw_patients(spark, sf_dir), BOUND)
    return sampling.sample_exact(selected, "Id", 400, BOUND.random_seed).select("Id", "STATE")


def oversample_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    selected = cohort.select_cohort(roles.raw_patients(spark, sf_dir), BOUND)
    drawn = sampling.oversample_exact(selected, "Id", 2500, BOUND.random_seed)
    return drawn.select("draw", "Id", "STATE")


def weighted_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucket = weighted_bucket("c_custkey", roles.SETTING_SEED, BOUND.care_setting_weights)
    return (
        roles.read(spark, sf_dir, "customer")
        .groupBy(bucket.alias("care_setting"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("c_custkey").alias("first_patient"))
    )


def match_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.assignments(spark, sf_dir).select(
        "patient_id", "nation", F.col("wanted_care_setting").alias("care_setting"), "provider_id", "match_tier"
    )


def table_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.table_fingerprint(roles.read(spark, sf_dir, "customer"))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = cohort.normalize_patients(roles.raw_patients(spark, sf_dir), BOUND)
    path = f"{files.new_stage(spark)}/patient.csv"
    files.write_csv_table(table, path)
    return files.read_csv_table(spark, path, table.schema)


def _published(spark: SparkSession, sf_dir: str, gold: str, observed: publish.Observed | None = None) -> str:
    """Folder of a run published to ``gold``."""
    return publish.publish(spark, observed or roles.observed(spark, sf_dir), BOUND, gold, gate=_hold_nothing)


def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish all seven tables, read them back from their files, and count and fingerprint what was read."""
    gold = files.new_stage(spark)
    _published(spark, sf_dir, gold)
    tables = publish.load_published(spark, gold)
    return publish.fingerprints(publish.fingerprint_leaves(tables))


def published_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest tree's leaves as the run reports them: rows and hash of every key range of the seven tables."""
    return publish.load_fingerprint_leaves(spark, _published(spark, sf_dir, files.new_stage(spark)))


def changed_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish twice, with the insurance of the frailest corrected in between, and name the key ranges that differ."""
    gold = files.new_stage(spark)
    observed = publish.staged_inputs(roles.observed(spark, sf_dir), BOUND, files.new_stage(spark))
    corrected = F.when(F.col("frailty_proxy") > 0.985, F.lit("medicaid")).otherwise(F.col("insurance_type"))
    later = dataclasses.replace(observed, patient=observed.patient.withColumn("insurance_type", corrected))
    runs = [_published(spark, sf_dir, gold, o) for o in (observed, later)]
    return serving.changed_ranges(*[publish.load_fingerprint_leaves(spark, run) for run in runs])


def kpi_report_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The KPI report of a published run, read back."""
    return publish.load_kpi_report(spark, _published(spark, sf_dir, files.new_stage(spark)))


def features_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features as known on the eligibility date: a referral delay observed later is not there."""
    return timeline.model_ready_features(journey(spark, sf_dir), as_of="eligibility_date")


def _raw_folder(spark: SparkSession, sf_dir: str) -> str:
    """Raw patients as a folder of CSV files, some records with a comma too many, as an export without quotes leaves them."""
    raw = roles.raw_patients(spark, sf_dir)
    split = F.concat(F.substring("ZIP", 1, 2), F.lit(","), F.substring("ZIP", 3, 3))
    damaged = raw.withColumn("ZIP", F.when(F.col("frailty_proxy").between(0.0905, 0.0995), split).otherwise(F.col("ZIP")))
    line = F.array_join(F.array(*[F.col(c).cast("string") for c in raw.columns]), ",", "")
    folder = f"{files.new_stage(spark)}/raw"
    lines = damaged.select(line.alias(",".join(raw.columns)))
    lines.write.option("header", True).option("sep", "\u0001").csv(f"{folder}/Patients.csv")
    files.write_csv_table(roles.read(spark, sf_dir, "supplier"), f"{folder}/payers.csv")
    return folder


def _cohort_of(size: int) -> Query:
    params = dataclasses.replace(BOUND, target_cohort_size=size)
    return lambda spark, sf_dir: intake.cohort_from_csv(spark, _raw_folder(spark, sf_dir), params)


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the raw folder that cannot be used, with the reason."""
    return intake.patient_intake(spark, _raw_folder(spark, sf_dir)).quarantined


def publish_held(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that its gate holds back: the rule results it left, and whether readers see it."""
    gold = files.new_stage(spark)
    try:
        publish.publish(spark, roles.observed(spark, sf_dir), BOUND, gold)
    except quality.CriticalQualityFailure:
        pass
    results = publish.load_quality_reports(spark, gold)
    return results.withColumn("published", F.lit(publish.has_published(spark, gold)))


def sql_top_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest gaps, asked of the registered views in SQL."""
    serving.register_tables({"patient_journey": journey(spark, sf_dir)})
    return spark.sql(
        "SELECT * FROM vw_treatment_gap_by_segment ORDER BY treatment_gap DESC, care_setting, "
        "provider_specialty, region, age_group, comorbidity_group LIMIT 20"
    )


def _registered(spark: SparkSession, sf_dir: str) -> None:
    """All seven tables and the eight views in the session's catalog, the tables bucketed by patient."""
    serving.register_tables(publish.build_bucketed(roles.observed(spark, sf_dir), BOUND, files.new_stage(spark)))


def sql_patient_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per patient from six registered tables, in SQL; all are bucketed by patient, so none is moved."""
    _registered(spark, sf_dir)
    return spark.sql(
        """
        SELECT p.patient_id, p.region, d.prostate_stage, o.outcome_status, j.eligible_for_arpi, j.persistent_12m,
          coalesce(t.n_treatments, 0) AS n_treatments, t.n_drugs, t.first_start, coalesce(e.n_encounters, 0) AS n_encounters, e.last_encounter
        FROM patient p
        JOIN diagnosis d ON d.patient_id = p.patient_id
        JOIN outcome o ON o.patient_id = p.patient_id
        JOIN patient_journey j ON j.patient_id = p.patient_id
        LEFT JOIN (SELECT patient_id, count(*) AS n_treatments, size(collect_set(drug_name)) AS n_drugs, min(treatment_start_date) AS first_start
                   FROM treatment GROUP BY patient_id) t ON t.patient_id = p.patient_id
        LEFT JOIN (SELECT patient_id, count(*) AS n_encounters, max(encounter_date) AS last_encounter
                   FROM encounter GROUP BY patient_id) e ON e.patient_id = p.patient_id"""
    )


def sql_provider_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per provider from the registered provider, treatment and encounter tables, in SQL."""
    _registered(spark, sf_dir)
    return spark.sql(
        """
        SELECT r.provider_id, r.provider_specialty, r.academic_flag, coalesce(t.n_treatments, 0) AS n_treatments,
          coalesce(t.n_stops, 0) AS n_stops, coalesce(e.n_encounters, 0) AS n_encounters
        FROM provider r
        LEFT JOIN (SELECT prescribing_provider_id, count(*) AS n_treatments, count_if(discontinuation_flag) AS n_stops
                   FROM treatment GROUP BY prescribing_provider_id) t ON t.prescribing_provider_id = r.provider_id
        LEFT JOIN (SELECT provider_id, count(*) AS n_encounters FROM encounter GROUP BY provider_id) e ON e.provider_id = r.provider_id"""
    )


def _hold_nothing(results: DataFrame) -> None:
    """These tables bind fills after death, which the gate would hold back."""


QUERIES: dict[str, Query] = {
    "gap_by_segment": _over_journey(serving.treatment_gap_by_segment),
    "top_segments": top_segments,
    "cohort_select": cohort_select,
    "cohort_normalize": cohort_normalize,
    "lenient_parse": lenient_parse,
    "stage_flags": stage_flags,
    "class_lookup": class_lookup,
    "eligibility": _eligibility,
    "initiation": _journey_columns(
        "eligible_for_arpi", "treatment_initiated", "days_to_initiation", "initiated_within_30d",
        "initiated_within_60d", "initiated_within_90d", "eligible_not_initiated_90d",
    ),
    "elapsed_days": _journey_columns(
        "referral_delay_days", "days_to_initiation", "days_to_discontinuation", "days_to_switch",
        "days_to_progression", "follow_up_days",
    ),
    "first_events": first_events,
    "first_record": first_record,
    "last_event": last_event,
    "event_log": event_log,
    "encounter": encounter,
    "referral_pathway": referral_pathway,
    "episodes": treatment_episodes,
    "lines_of_therapy": lines,
    "discontinuation": discontinuation,
    "restart": restart,
    "refill_calendar": refill_calendar,
    "treatment": treatment,
    "outcome_status": outcome_status,
    "persistence": _journey_columns(
        "treatment_initiated", "follow_up_days", "persistent_3m", "persistent_6m", "persistent_12m",
        "discontinued_within_12m",
    ),
    "persistence_sensitivity": _journey_columns(
        "persistent_12m", "persistent_12m_gap_30d", "persistent_12m_gap_60d", "persistent_12m_gap_90d"
    ),
    "journey": journey,
    "journey_from_tables": journey_from_tables,
    "features": _over_journey(timeline.model_ready_features),
    "v_eligible": _over_journey(serving.eligible_population),
    "v_not_initiated": _over_journey(serving.eligible_not_initiated),
    "v_initiation": _over_journey(serving.treatment_initiation),
    "v_persistence": _over_journey(serving.persistence),
    "v_switches": _over_journey(serving.switches),
    "v_referral_delays": _over_journey(serving.referral_delays),
    "v_final_outcomes": _over_journey(serving.final_outcomes),
    "dq_suite": _audit,
    "dq_gate": dq_gate,
    "duplicate_keys": duplicate_keys,
    "fk_orphans": fk_orphans,
    "coverage_gap": coverage_gap,
    "after_terminal": after_terminal,
    "missingness": _over_journey(serving.missingness),
    "kpi_long": _over_journey(lambda j: serving.kpis(j, BOUND)),
    "value_counts": _over_journey(serving.value_counts),
    "distinct_regions": distinct_regions,
    "org_rollup": org_rollup,
    "sample_exact": sample_exact,
    "oversample_exact": oversample_exact,
    "weighted_bucket": weighted_buckets,
    "match_fallback": match_fallback,
    "table_fingerprint": table_fingerprint,
    "csv_roundtrip": csv_roundtrip,
    "cohort_from_csv": _cohort_of(400),
    "cohort_from_csv_oversampled": _cohort_of(25_000),
    "csv_quarantine": csv_quarantine,
    "publish_roundtrip": publish_roundtrip,
    "published_fingerprints": published_fingerprints,
    "changed_ranges": changed_ranges,
    "kpi_report_roundtrip": kpi_report_roundtrip,
    "features_as_of": features_as_of,
    "publish_held": publish_held,
    "sql_top_segments": sql_top_segments,
    "sql_patient_summary": sql_patient_summary,
    "sql_provider_summary": sql_provider_summary,
}
