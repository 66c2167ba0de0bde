"""Lines of therapy: runs of one drug over the full order of a patient's fills.

A run needs every fill in order, so fills cannot be folded to days first. Fills alike in day, sequence and
drug fold map-side, and the fold is staged, so that it is made once and its size is known. A patient's
fills are one slice, unless there are more than a limit of them: those patients are cut along the order, by
day and within a day by ``fill_seq`` in steps of a fixed width. Runs are found inside each slice, and
runs that meet at a border are joined by a window over slice summaries alone. So no task ever
holds more of a patient than the limit, nor all of one of its days. The number of tasks grows with the files
that the fills come from. A missing drug is a drug of its own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sojourn.functions.expr import days_between, truth
from sojourn.params import Params
from sojourn.sources.files import new_stage, spread, stage_table, task_count

#: Steps of ``fill_seq`` in one slice of a day.
SLICE_WIDTH = 4096
#: Folded fills up to which a patient is one slice; some 4 MB.
PATIENT_LIMIT = 65_536

SLICE = ("patient_id", "slice_day", "part")
#: The day of a slice that holds a whole patient; which day does not matter, as such a patient has no other slice.
WHOLE = dt.date(1970, 1, 1)


def _drug() -> Column:
    """The drug wrapped, so that a missing drug and a missing row differ."""
    return F.struct(F.col("drug_name").alias("name"))


def _sliced(folded: DataFrame, slice_width: int, patient_limit: int) -> tuple[DataFrame, bool]:
    """Folded fills with their slice, and whether any patient has several. Those are at most one for each ``patient_limit`` rows."""
    stage = new_stage(folded.sparkSession)
    counts = folded.groupBy("patient_id").agg(F.count(F.lit(1)).alias("_n"))
    large = stage_table(counts.filter(F.col("_n") > patient_limit).select("patient_id", F.lit(True).alias("_large")), stage, "_large")
    whole = {"slice_day": F.lit(WHOLE), "part": F.lit(0).cast("bigint")}
    if large.isEmpty():
        return folded.withColumns(whole), False
    part = F.coalesce(F.floor(F.col("fill_seq") / slice_width), F.lit(-(2**62)))
    cut = {"slice_day": F.col("day"), "part": part}
    marked = folded.join(large, "patient_id", "left")
    return marked.withColumns({n: F.when(F.col("_large"), cut[n]).otherwise(whole[n]) for n in whole}).drop("_large"), True


def _sliced_runs(rows: DataFrame) -> DataFrame:
    """Runs of one drug within a slice, numbered from 1, with the run that follows."""
    in_order = Window.partitionBy(*SLICE).orderBy("day", "fill_seq", "drug_name")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.lag(_drug()).over(in_order)
    goes_on = before.isNotNull() & before["name"].eqNullSafe(F.col("drug_name"))
    by_run = Window.partitionBy(*SLICE).orderBy("line_no")
    return (
        rows.withColumn("_new", (~goes_on).cast("bigint"))
        .withColumn("line_no", F.sum("_new").over(so_far))
        .groupBy(*SLICE, "line_no", "drug_name")
        .agg(
            F.min("day").alias("first_day"),
            F.max("day").alias("last_day"),
            F.max("covered_date").alias("covered_date"),
            F.sum("n_fills").alias("n_fills"),
        )
        .withColumn("next_run", F.lead(F.struct(F.col("drug_name").alias("drug"), F.col("first_day").alias("start"))).over(by_run))
    )


def _joined_runs(sliced: DataFrame) -> DataFrame:
    """Runs of whole patients, from those of slices joined where slices meet."""
    by_slice = Window.partitionBy("patient_id").orderBy("slice_day", "part")
    prior = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    last = F.lag("_last").over(by_slice)
    meets = (last.isNotNull() & last["name"].eqNullSafe(F.col("_first.name"))).cast("bigint")
    closed = F.coalesce(F.sum(F.col("_runs") - F.col("_meets")).over(prior), F.lit(0))
    # A slice whose first run continues the slice before shares that run's number.
    borders = (
        sliced.groupBy(*SLICE)
        .agg(
            F.max("line_no").alias("_runs"),
            F.max(F.when(F.col("line_no") == 1, _drug())).alias("_first"),
            F.max(F.when(F.col("next_run").isNull(), _drug())).alias("_last"),
            F.min("first_day").alias("_start"),
            F.sum("n_fills").alias("_fills"),
            F.max("covered_date").alias("_covered"),
        )
        # True of every slice. It reads what the other side of the join reads, so that both
        # share one exchange and the fold is read once.
        .filter((F.col("_fills") > 0) | F.col("_covered").isNotNull())
        .withColumn("_meets", meets)
        .select(
            *SLICE,
            (closed - F.col("_meets")).alias("_offset"),
            F.lead(F.struct(F.col("_first.name").alias("drug"), F.col("_start").alias("start"))).over(by_slice).alias("_border"),
        )
    )
    following = F.coalesce("next_run", "_border")
    goes_on = following.isNotNull() & following["drug"].eqNullSafe(F.col("drug_name"))
    return (
        sliced.join(borders, list(SLICE))
        .withColumn("line_no", F.col("_offset") + F.col("line_no"))
        .withColumn("next_run", F.when(~goes_on, following))
        .groupBy("patient_id", "line_no", "drug_name")
        .agg(
            F.min("first_day").alias("line_start_date"),
            F.max("last_day").alias("last_fill_date"),
            F.max("covered_date").alias("covered_date"),
            F.sum("n_fills").alias("n_fills"),
            F.max("next_run").alias("next_run"),
        )
    )


def lines_of_therapy(
    fills: DataFrame, index: DataFrame, params: Params, index_date: str = "index_date",
    slice_width: int = SLICE_WIDTH, patient_limit: int = PATIENT_LIMIT,
) -> DataFrame:
    """One row per line: drug, span, fills, and the switch to the next line if there is one.

    A line ends where the next fill is of another drug. It is a switch when the
    next line starts within the switch window after coverage. ``slice_width`` and ``patient_limit``
    move no result; fills without ``fill_seq`` come first in their day.
    """
    end = F.lit(params.observation_end_date)
    supply = F.coalesce(F.col("days_supply"), F.lit(params.days_supply)).cast("int")
    tasks = task_count(fills)
    # dealt like the fills, which would be dealt like the index otherwise
    anchors = spread(index.select("patient_id", F.col(index_date).alias("_index")), "patient_id", tasks=tasks)
    exposed = (
        spread(fills.filter(F.col("fill_date") < end), "patient_id", tasks=tasks)
        .join(anchors, "patient_id")
        .filter(F.col("fill_date") >= F.col("_index"))
    )
    folded = exposed.groupBy("patient_id", F.col("fill_date").alias("day"), "fill_seq", "drug_name").agg(
        F.max(F.date_add("fill_date", supply)).alias("covered_date"), F.count(F.lit(1)).alias("n_fills")
    )
    folded = stage_table(folded, new_stage(fills.sparkSession), "_fill_order")
    rows, cut = _sliced(folded, slice_width, patient_limit)
    runs = _sliced_runs(spread(rows, *(SLICE if cut else SLICE[:1]), tasks=tasks))
    # where no patient was cut there are no borders: its runs are its lines
    runs = _joined_runs(runs) if cut else runs.withColumnsRenamed({"first_day": "line_start_date", "last_day": "last_fill_date"})

    covered_until = F.least(F.col("covered_date"), end)
    in_time = F.col("next_run.start") <= F.date_add("covered_until_date", params.switch_window_days)
    switch = F.col("switch_flag")
    return (
        runs.withColumn("covered_until_date", covered_until)
        .withColumn("switch_flag", truth(in_time))
        .select(
            "patient_id",
            "line_no",
            "drug_name",
            "line_start_date",
            "last_fill_date",
            "covered_until_date",
            "n_fills",
            "switch_flag",
            F.when(switch, F.col("next_run.start")).alias("switch_date"),
            F.when(switch, F.col("drug_name")).alias("previous_drug"),
            F.when(switch, F.col("next_run.drug")).alias("switched_to_drug"),
            F.when(switch, days_between("next_run.start", "line_start_date")).alias("days_to_switch"),
        )
    )
