"""Key integrity: duplicates, orphans, coverage and event-after-date checks.

Keys are counted before they are joined, so a key that fills a third of a
table is one row by the time it is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key (nulls equal), as one count."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    extra = F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint")
    return counts.agg(extra.alias("failure_count"))


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys missing from the parent with their row counts; a null key is an orphan."""
    counted = child.groupBy(F.col(child_key).alias("orphan_key")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    known = parent.select(F.col(parent_key).alias("orphan_key")).distinct()
    return counted.join(known, "orphan_key", "left_anti")


def coverage_gap(parent: DataFrame, parent_key: str, child: DataFrame, child_key: str) -> DataFrame:
    """Distinct parent keys that no child row carries."""
    wanted = parent.select(F.col(parent_key).alias("uncovered_key")).distinct()
    have = child.select(F.col(child_key).alias("uncovered_key")).distinct()
    return wanted.join(have, "uncovered_key", "left_anti")


def key_census(sources: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Row count of every key in every source: one row per key, one column per source.

    Rows are counted map-side before the one shuffle, which then answers
    uniqueness, orphan and coverage questions together.
    """
    tagged: DataFrame | None = None
    for number, (df, key) in enumerate(sources.values()):
        rows = df.select(F.col(key).alias("key"), F.lit(number).alias("source"))
        tagged = rows if tagged is None else tagged.unionByName(rows)
    if tagged is None:
        raise ValueError("key_census needs at least one source")
    counts = [F.count_if(F.col("source") == n).alias(name) for n, name in enumerate(sources)]
    return tagged.groupBy("key").agg(*counts)


def ordered_pairs(
    left: DataFrame, left_date: str, right: DataFrame, right_date: str, key: str
) -> DataFrame:
    """Number of (left, right) rows of one key with right date on or before left date.

    Counts what an inner join would yield without forming the pairs: rows are
    counted per key and day, and a running total of right rows over the key's
    calendar meets each left day once.
    """
    sides = [
        df.select(F.col(key).alias("_key"), F.col(date).alias("_date"), F.lit(side).alias("_side"))
        for side, df, date in ((0, left, left_date), (1, right, right_date))
    ]
    known = F.col("_key").isNotNull() & F.col("_date").isNotNull()
    days = sides[0].unionByName(sides[1]).filter(known).groupBy("_key", "_date").agg(
        F.count_if(F.col("_side") == 0).alias("_left"), F.count_if(F.col("_side") == 1).alias("_right")
    )
    up_to = Window.partitionBy("_key").orderBy("_date").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    met = days.withColumn("_met", F.col("_left") * F.sum("_right").over(up_to))
    return met.agg(F.coalesce(F.sum("_met"), F.lit(0)).cast("bigint").alias("pairs"))


def after_terminal(
    events: DataFrame, event_date: str, terminal: DataFrame, terminal_date: str,
    key: str = "patient_id", counted: str | None = None,
) -> DataFrame:
    """Events per subject dated after its terminal date; no terminal date, no failure.

    Events are counted per day first, so the join sees at most one row per
    subject and calendar day. ``counted`` names the number of events that a row stands for.
    """
    number = F.count(F.lit(1)) if counted is None else F.sum(counted)
    days = events.groupBy(key, F.col(event_date).alias("_date")).agg(number.alias("_n"))
    ends = terminal.groupBy(key).agg(F.min(terminal_date).alias("terminal_date"))
    return (
        days.join(ends, key)
        .filter(F.col("_date") > F.col("terminal_date"))
        .groupBy(key, "terminal_date")
        .agg(F.sum("_n").alias("n_after"), F.max("_date").alias("last_event_date"))
    )
