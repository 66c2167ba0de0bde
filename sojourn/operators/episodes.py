"""Treatment episodes, stops, restarts and refill calendars from observed fills.

A fill is (patient_id, fill_date, fill_seq, drug_name, provider_id,
days_supply); ``fill_seq`` orders fills of one day and ``drug_name`` breaks
what ties remain.

Fills are first folded to one row per patient, day and drug. That fold keeps every
figure the episode rules need and caps a patient at (days observed x drugs) rows, so
the windows below are bounded whatever share of all fills one patient holds. Large
inputs are dealt by patient before the fold, in which a task holds folded rows alone;
all later steps keep that distribution, so fills move once. Small ones fold map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sojourn.functions.expr import days_between, literal_map, sql_columns, surrogate_key, truth
from sojourn.operators.outcomes import follow_up
from sojourn.params import DRUG_CLASS, Params
from sojourn.sources.files import spread


def fill_days(fills: DataFrame, params: Params) -> DataFrame:
    """One row per patient, fill day and drug, dealt by patient if there are many. Primitive buffers only, so hash-aggregated."""
    supply = F.coalesce(F.col("days_supply"), F.lit(params.days_supply)).cast("int")
    dealt = spread(fills, "patient_id")
    return dealt.groupBy("patient_id", "fill_date", "drug_name").agg(
        F.max(F.date_add("fill_date", supply)).alias("covered_date"),
        F.min("fill_seq").alias("first_seq"),
        F.min("provider_id").alias("provider_id"),
        F.count(F.lit(1)).alias("n_fills"),
    )


def treatment_episodes(
    fills: DataFrame, index: DataFrame, params: Params, index_date: str = "index_date",
    grace: bool = False,
) -> DataFrame:
    """Episodes of fills, see ``episodes_of_days``."""
    observed = fills.filter(F.col("fill_date") < F.lit(params.observation_end_date))
    return episodes_of_days(fill_days(observed, params), index, params, index_date, grace)


def episodes_of_days(
    days: DataFrame, index: DataFrame, params: Params, index_date: str = "index_date",
    grace: bool = False,
) -> DataFrame:
    """Contiguous exposure per patient: a new episode starts past the allowable gap.

    ``days`` are fills folded by ``fill_days``; those past the end of observation do not count.

    ``index`` has one row per patient. Coverage runs to the latest supply end
    seen so far (overlapping fills do not shorten it) and is capped at the end
    of observation; ``grace`` extends it by the allowable gap.
    """
    end = F.lit(params.observation_end_date)
    gap = params.allowable_gap_days
    days = days.filter(F.col("fill_date") < end)
    # One date a patient is the smaller side by far; hashing it spares a sort of all days.
    anchors = index.select("patient_id", F.col(index_date).alias("_index")).hint("shuffle_hash")
    exposed = days.join(anchors, "patient_id").filter(F.col("fill_date") >= F.col("_index"))

    # Both windows share one partitioning and order, so one sort serves them.
    in_order = Window.partitionBy("patient_id").orderBy("fill_date", "first_seq", "drug_name")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    past_gap = F.col("fill_date") > F.date_add("_covered_before", gap)
    # A struct is there at every opening, even if the drug or the provider is not.
    opening = F.struct(F.col("drug_name").alias("drug"), F.col("provider_id").alias("provider"))
    marked = (
        exposed.withColumn("_covered_before", F.max("covered_date").over(earlier))
        .withColumn("_opens", F.col("_covered_before").isNull() | past_gap)
        .withColumns(
            {
                "episode_no": F.sum(F.col("_opens").cast("int")).over(so_far),
                "_opening": F.last(F.when(F.col("_opens"), opening), ignorenulls=True).over(so_far),
            }
        )
        .withColumns({"_drug": F.col("_opening.drug"), "_provider": F.col("_opening.provider")})
    )
    other = F.struct("fill_date", "first_seq", "drug_name")
    since_cover = days_between("fill_date", "_covered_before")
    # The gap before an opening fill lies between episodes, not inside one.
    inner_gap = F.when(~F.col("_opens") & (since_cover > 0), since_cover)
    covered = F.max("covered_date")
    if grace:
        covered = F.date_add(covered, gap)
    grouped = marked.groupBy("patient_id", "episode_no", "_drug", "_provider").agg(
        F.min("fill_date").alias("episode_start_date"),
        F.max("fill_date").alias("last_fill_date"),
        F.least(covered, end).alias("covered_until_date"),
        F.sum("n_fills").alias("n_fills"),
        F.coalesce(F.max(inner_gap), F.lit(0)).cast("bigint").alias("max_refill_gap_days"),
        F.min(F.when(~F.col("drug_name").eqNullSafe(F.col("_drug")), other)).alias("_other"),
    )
    return grouped.select(
        "patient_id",
        F.col("episode_no").cast("int").alias("episode_no"),
        F.col("_drug").alias("drug_name"),
        F.col("_provider").alias("provider_id"),
        "episode_start_date",
        "last_fill_date",
        "covered_until_date",
        "n_fills",
        "max_refill_gap_days",
        F.col("_other.fill_date").alias("other_drug_date"),
        F.col("_other.drug_name").alias("other_drug"),
        F.col("_other").isNotNull().alias("has_other_drug"),
    )


def with_drug_class(df: DataFrame) -> DataFrame:
    return df.withColumn("drug_class", literal_map(DRUG_CLASS, "drug_name"))


def regimen_name(drug: str = "drug_name") -> Column:
    return F.concat(F.lit("synthetic_"), drug, F.lit("_regimen"))


def with_neighbours(episodes: DataFrame) -> DataFrame:
    """Add each episode's drug class, the next episode's start and class, and last activity."""
    in_order = Window.partitionBy("patient_id").orderBy("episode_no")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return with_drug_class(episodes).withColumns(
        {
            "next_episode_date": F.lead("episode_start_date").over(in_order),
            "next_drug_class": F.lead("drug_class").over(in_order),
            "last_activity_date": F.max("last_fill_date").over(whole),
        }
    )


def discontinuation(episodes: DataFrame, params: Params) -> DataFrame:
    """Definitive stops: one drug, and the whole allowable gap observed before ``censor_date``."""
    observed = F.date_add("covered_until_date", params.allowable_gap_days) <= F.col("censor_date")
    stop = truth(observed & ~F.col("has_other_drug"))
    return episodes.withColumn("discontinuation_flag", stop).withColumn(
        "discontinuation_date", F.when(F.col("discontinuation_flag"), F.col("covered_until_date"))
    )


def restart(stopped: DataFrame, params: Params) -> DataFrame:
    """Stops followed by an episode of the same class within observation."""
    again = truth(
        F.col("discontinuation_flag")
        & (F.col("next_drug_class") == F.col("drug_class"))
        & (F.col("next_episode_date") <= F.lit(params.observation_end_date))
    )
    return (
        stopped.withColumn("restart_flag", again)
        .withColumn("restart_date", F.when(F.col("restart_flag"), F.col("next_episode_date")))
        .withColumn("temporary_gap_flag", F.col("restart_flag"))
    )


def refill_calendar(episodes: DataFrame, params: Params) -> DataFrame:
    """Expected refill dates per episode, every supply period from start to coverage end."""
    step = F.expr(f"INTERVAL '{params.days_supply}' DAY")
    dates = F.sequence("episode_start_date", "covered_until_date", step)
    return episodes.select(
        "patient_id",
        "episode_no",
        "n_fills",
        F.size(dates).cast("bigint").alias("expected_fills"),
        F.posexplode(dates).alias("refill_no", "expected_refill_date"),
    )


def with_course(rows: DataFrame, params: Params) -> DataFrame:
    """Follow-up, stop and restart of episode rows that also carry ``death_date``."""
    followed = rows.withColumns(follow_up(F.col("death_date"), F.col("last_activity_date"), params))
    return restart(discontinuation(followed, params), params)


def treatment_history(
    fills: DataFrame, spine: DataFrame, params: Params, index_date: str = "eligibility_date", days: DataFrame | None = None
) -> DataFrame:
    """All episodes with follow-up, stops and restarts, in one distribution by patient.

    ``spine`` has one row per patient with the index date, death_date and
    adverse_event_date. ``days`` are fills folded by ``fill_days`` before.
    """
    found = treatment_episodes(fills, spine, params, index_date) if days is None else episodes_of_days(days, spine, params, index_date)
    episodes = with_neighbours(found)
    dates = spine.select("patient_id", "death_date", "adverse_event_date")
    return with_course(episodes.join(dates, "patient_id"), params)


def treatment_columns(params: Params) -> dict[str, Column]:
    """Treatment attributes of one episode row with its course and adverse_event_date."""
    reason = "CASE WHEN adverse_event_date <= discontinuation_date THEN 'adverse_event' ELSE 'other' END"
    return sql_columns(
        {
            "drug_name": "drug_name",
            "drug_class": "drug_class",
            "regimen_name": "concat('synthetic_', drug_name, '_regimen')",
            "treatment_line": "episode_no",
            "treatment_start_date": "episode_start_date",
            "treatment_end_date": "CASE WHEN discontinuation_flag AND NOT restart_flag "
            "THEN discontinuation_date ELSE covered_until_date END",
            "days_supply": str(params.days_supply),
            "refill_date": "episode_start_date",
            "covered_until_date": "covered_until_date",
            "prescribing_provider_id": "provider_id",
            "discontinuation_flag": "discontinuation_flag",
            "discontinuation_date": "discontinuation_date",
            "discontinuation_reason": f"CASE WHEN discontinuation_flag THEN {reason} END",
            "switch_flag": "has_other_drug",
            "switch_date": "other_drug_date",
            "previous_drug": "CASE WHEN has_other_drug THEN drug_name END",
            "switched_to_drug": "other_drug",
            "restart_flag": "restart_flag",
            "restart_date": "restart_date",
            "temporary_gap_flag": "temporary_gap_flag",
            "max_refill_gap_days": "max_refill_gap_days",
            "synthetic_event_flag": "true",
        }
    )


def treated_patients(history: DataFrame) -> DataFrame:
    """Last activity and first-treatment flags: the part of the history an outcome needs."""
    return history.filter(F.col("episode_no") == 1).select(
        "patient_id",
        "last_activity_date",
        "restart_flag",
        F.col("has_other_drug").alias("switch_flag"),
        "discontinuation_flag",
    )


def switch_columns() -> dict[str, Column]:
    """What differs in the line that a switch begins: the new drug from the switch on, nothing ended."""
    return {
        **sql_columns(
            {
                "drug_name": "other_drug",
                "regimen_name": "concat('synthetic_', other_drug, '_regimen')",
                "treatment_line": "episode_no + 1",
                "treatment_start_date": "other_drug_date",
                "treatment_end_date": "covered_until_date",
                "refill_date": "other_drug_date",
                "discontinuation_flag": "false",
                "discontinuation_date": "cast(null AS DATE)",
                "discontinuation_reason": "cast(null AS STRING)",
                "switch_flag": "false",
                "switch_date": "cast(null AS DATE)",
                "previous_drug": "drug_name",
                "switched_to_drug": "cast(null AS STRING)",
                "restart_flag": "false",
                "restart_date": "cast(null AS DATE)",
                "temporary_gap_flag": "false",
            }
        ),
        "drug_class": literal_map(DRUG_CLASS, "other_drug"),
    }


def build_treatments(history: DataFrame, params: Params) -> DataFrame:
    """Treatment rows, one per episode and one more per switch, without the prescriber's attributes.

    A switch's row has the next line number and the key of its episode with an S; it is made from the
    same episode row, so the history is computed once.
    """
    key = surrogate_key("TR", F.col("patient_id"), F.col("episode_no") - 1)
    lines = F.when(F.col("has_other_drug"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    rows = history.withColumn("_switched", F.explode(lines))
    switched, after = F.col("_switched"), switch_columns()
    columns = {
        name: F.when(switched, after[name]).otherwise(column) if name in after else column
        for name, column in treatment_columns(params).items()
    }
    return rows.select(
        F.concat(key, F.when(switched, "S").otherwise("")).alias("treatment_id"),
        "patient_id",
        *[column.alias(name) for name, column in columns.items()],
    )


#: Columns in the order of the table.
TREATMENT_COLUMNS = (
    "treatment_id",
    "patient_id",
    "drug_name",
    "drug_class",
    "regimen_name",
    "treatment_line",
    "treatment_start_date",
    "treatment_end_date",
    "days_supply",
    "refill_date",
    "covered_until_date",
    "treatment_setting",
    "prescribing_specialty",
    "prescribing_provider_id",
    "discontinuation_flag",
    "discontinuation_date",
    "discontinuation_reason",
    "switch_flag",
    "switch_date",
    "previous_drug",
    "switched_to_drug",
    "restart_flag",
    "restart_date",
    "temporary_gap_flag",
    "max_refill_gap_days",
    "synthetic_event_flag",
)


def with_prescriber(treatments: DataFrame, provider: DataFrame) -> DataFrame:
    """The published treatment table: setting and specialty of the prescriber looked up."""
    prescriber = provider.select(
        F.col("provider_id").alias("prescribing_provider_id"),
        F.col("care_setting").alias("treatment_setting"),
        F.col("provider_specialty").alias("prescribing_specialty"),
    )
    return treatments.join(prescriber, "prescribing_provider_id", "left").select(*TREATMENT_COLUMNS)
