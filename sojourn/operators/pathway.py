"""First events, first records, referral pathways and the encounter log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sojourn.functions.expr import days_between, surrogate_key


def first_events(
    events: DataFrame, types: Mapping[str, str], subject: str = "patient_id",
    kind: str = "event_type", date: str = "event_date",
) -> DataFrame:
    """First date per subject for each wanted event type, in one pass.

    ``types`` maps an event type to its output column.
    """
    firsts = [F.min(F.when(F.col(kind) == t, F.col(date))).alias(name) for t, name in types.items()]
    return events.filter(F.col(kind).isin(*types)).groupBy(subject).agg(*firsts)


def first_record(
    records: DataFrame, subject: str, order: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """The whole first row per subject by a total order; partial results combine map-side."""
    row = F.struct(*[F.col(c) for c in keep])
    first = F.min_by(row, F.struct(*[F.col(c) for c in order]))
    return records.groupBy(subject).agg(first.alias("_first")).select(subject, "_first.*")


def last_event(records: DataFrame, dates: Sequence[str], subject: str = "patient_id") -> DataFrame:
    """Latest of several date columns over all rows of a subject; nulls are skipped."""
    latest = F.greatest(*[F.col(c) for c in dates]) if len(dates) > 1 else F.col(dates[0])
    return records.groupBy(subject).agg(F.max(latest).alias("last_event_date"))


def attach_first_dates(
    index: DataFrame, events: DataFrame, index_date: str, types: Mapping[str, str],
    details: Mapping[str, str] | None = None, subject: str = "patient_id",
) -> DataFrame:
    """Add to each index row the first date per event type on or after its index date.

    ``details`` names, for some types, a column to receive ``event_detail`` of
    that first event. Events are folded map-side to the set of days per type
    (with details, to one detail per day first), so state per subject is
    bounded by the calendar.
    """
    details = dict(details or {})
    wanted = events.filter(F.col("event_type").isin(*types))
    if details:
        wanted = wanted.groupBy(subject, "event_type", "event_date").agg(
            F.min("event_detail").alias("event_detail")
        )
    kind, date = F.col("event_type"), F.col("event_date")

    def entry(name: str) -> Column:
        return F.struct(date.alias("date"), F.col("event_detail").alias("detail")) if name in details else date

    sets = wanted.groupBy(subject).agg(
        *[F.collect_set(F.when(kind == t, entry(t))).alias(f"_{name}") for t, name in types.items()]
    )
    after = F.col(index_date)
    joined = index.join(sets, subject, "left")
    for name, column in types.items():
        if name in details:
            first = F.array_min(F.filter(f"_{column}", lambda e: e["date"] >= after))
            joined = joined.withColumn(column, first["date"]).withColumn(details[name], first["detail"])
        else:
            first = F.array_min(F.filter(f"_{column}", lambda day: day >= after))
            joined = joined.withColumn(column, first)
    return joined.drop(*[f"_{name}" for name in types.values()])


def referral_pathway(
    events: DataFrame, source_type: str, target_type: str, subject: str = "patient_id"
) -> DataFrame:
    """First source visit, first target visit on or after it, and the delay between them.

    Target dates are gathered as a set of calendar days, so the state per
    subject is bounded by the calendar however many events it has.
    """
    kind, date = F.col("event_type"), F.col("event_date")
    source, targets = F.col("source_date"), F.col("_targets")
    target = F.array_min(F.filter(targets, lambda day: day >= source))
    return (
        events.filter(kind.isin(source_type, target_type))
        .groupBy(subject)
        .agg(
            F.min(F.when(kind == source_type, date)).alias("source_date"),
            F.collect_set(F.when(kind == target_type, date)).alias("_targets"),
        )
        .select(subject, "source_date", target.alias("target_date"))
        .withColumn("referral_completed_flag", F.col("target_date").isNotNull())
        .withColumn("referral_delay_days", days_between("target_date", "source_date"))
    )


def event_log(frames: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Union of typed event rows: ``{event_type: (frame, subject column, date column)}``."""
    log: DataFrame | None = None
    for name, (frame, subject, date) in frames.items():
        rows = frame.filter(F.col(date).isNotNull()).select(
            F.col(subject).alias("patient_id"),
            F.lit(name).alias("event_type"),
            F.col(date).cast("date").alias("event_date"),
        )
        log = rows if log is None else log.unionByName(rows)
    if log is None:
        raise ValueError("event_log needs at least one frame")
    return log


def build_encounters(visits: DataFrame) -> DataFrame:
    """Encounter rows from one visit row per patient: diagnosis, urology, oncology.

    ``visits`` holds patient_id, diagnosis_date, source_date and target_date.
    Rows are made in place with explode, so nothing is shuffled.
    """
    completed = F.col("target_date").isNotNull()
    no_text, no_date = F.lit(None).cast("string"), F.lit(None).cast("date")

    def visit(
        number: int, date: str, kind: str, specialty: str, referral: Column,
        source: Column, target: Column, referred: Column, done: Column, done_on: Column,
    ) -> Column:
        return F.struct(
            F.lit(number).alias("number"),
            F.col(date).alias("encounter_date"),
            F.lit(kind).alias("encounter_type"),
            F.lit(specialty).alias("specialty"),
            referral.alias("referral_flag"),
            source.alias("referral_source_specialty"),
            target.alias("referral_target_specialty"),
            referred.alias("referral_date"),
            done.alias("referral_completed_flag"),
            done_on.alias("referral_completion_date"),
        )

    urology, oncology = F.lit("urology"), F.lit("medical_oncology")
    rows = F.array(
        visit(0, "diagnosis_date", "diagnosis", "urology", F.lit(False), no_text, no_text,
              no_date, F.lit(False), no_date),
        visit(1, "source_date", "urology_follow_up", "urology", completed,
              F.when(completed, urology), F.when(completed, oncology),
              F.when(completed, F.col("source_date")), completed, F.col("target_date")),
        visit(2, "target_date", "oncology_consultation", "medical_oncology", F.lit(False),
              urology, oncology, F.col("source_date"), F.lit(True), F.col("target_date")),
    )
    return (
        visits.withColumn("v", F.explode(rows))
        .filter(F.col("v.encounter_date").isNotNull())
        .select(
            surrogate_key("ENC", F.col("patient_id"), F.col("v.number")).alias("encounter_id"),
            "patient_id",
            "v.encounter_date",
            "v.encounter_type",
            "v.specialty",
            "v.referral_flag",
            "v.referral_source_specialty",
            "v.referral_target_specialty",
            "v.referral_date",
            "v.referral_completed_flag",
            "v.referral_completion_date",
            F.lit(True).alias("synthetic_event_flag"),
        )
    )


#: Columns in the order of the table.
ENCOUNTER_COLUMNS = (
    "encounter_id",
    "patient_id",
    "provider_id",
    "organization_id",
    "encounter_date",
    "encounter_type",
    "specialty",
    "care_setting",
    "referral_flag",
    "referral_source_specialty",
    "referral_target_specialty",
    "referral_date",
    "referral_completed_flag",
    "referral_completion_date",
    "synthetic_event_flag",
)


def with_visited_provider(encounters: DataFrame, assignment: DataFrame) -> DataFrame:
    """The published encounter table: each patient's assigned provider on its visits."""
    seen = assignment.select("patient_id", "provider_id", "organization_id", "care_setting")
    return encounters.join(seen, "patient_id", "left").select(*ENCOUNTER_COLUMNS)
