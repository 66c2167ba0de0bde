"""Exact-size samples and dense row numbers without a single-task sort.

Rows are ordered by a keyed hash and then by the key. A sample is the rows up to a cut in that order. The
cut is found by radix select: a histogram of the leading hex digits tells which digit group holds it, the
next histogram looks into that group alone, and so on until the group is small; only keys at the
cut are ever ranked. For dense numbers the order is cut into as many digit groups as it takes to keep
them small, and a row's position is the size of all lower groups plus its rank inside its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sojourn.functions.expr import hex_to_long, keyed_hash

#: Digits of one histogram, which has 16**STEP_DIGITS bars at most.
STEP_DIGITS = 3
HASH_DIGITS = 32
#: Keys that one task ranks, about.
RANKED_KEYS = 50_000


def group_digits(rows: int, per_group: int = RANKED_KEYS) -> int:
    """Leading hex digits that cut rows into groups of about per_group, never a group alone at the start."""
    digits = 1
    while digits < 12 and rows > per_group * 16**digits:
        digits += 1
    return digits


def radix_cut(df: DataFrame, key: str, size: int, seed: int, per_group: int = RANKED_KEYS) -> tuple[str, int] | None:
    """Digits of the group in which the first ``size`` rows end, and how many of its rows belong to them.

    None if there are no more than ``size`` rows. One histogram of at most 4,096 bars a level reaches the driver.
    """
    digest, prefix, left = keyed_hash(seed, key), "", size
    hashed = df.select(digest.alias("_hash"))
    while True:
        inside = hashed.filter(F.col("_hash").startswith(prefix)) if prefix else hashed
        group = F.substring("_hash", 1, len(prefix) + STEP_DIGITS)
        bars = inside.groupBy(group.alias("g")).agg(F.count(F.lit(1)).alias("n")).collect()
        if not prefix and sum(bar["n"] for bar in bars) <= size:
            return None
        for bar in sorted(bars, key=lambda bar: bar["g"]):
            if left <= bar["n"]:
                prefix, rows = bar["g"], bar["n"]
                break
            left -= bar["n"]
        if rows <= per_group or len(prefix) + STEP_DIGITS > HASH_DIGITS:
            return prefix, left


def sample_exact(df: DataFrame, key: str, size: int, seed: int, per_group: int = RANKED_KEYS) -> DataFrame:
    """Exactly ``size`` rows (all, if fewer) without replacement; same rows on every run.

    Equals ordering by the keyed hash and taking the first ``size`` rows. All rows before the group of the
    cut are taken by a filter, without being moved; only the rows of that group are ordered.
    """
    if size <= 0:
        return df.limit(0)
    cut = radix_cut(df, key, size, seed, per_group)
    if cut is None:
        return df
    prefix, left = cut
    hashed = df.withColumn("_hash", keyed_hash(seed, key))
    group = F.substring("_hash", 1, len(prefix))
    below = hashed.filter(group < prefix)
    at_cut = hashed.filter(group == prefix).orderBy("_hash", key).limit(left)
    return below.unionByName(at_cut).drop("_hash")


def _before(counts: DataFrame, cell: Sequence[str], group: str, high: Column) -> DataFrame:
    """Adds _before, the rows of lower groups within a cell; running sums go over groups of a high part, then over high parts."""
    counts = counts.withColumn("_high", high)
    within = Window.partitionBy(*cell, "_high").orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy(*(cell or [F.lit(0)])).orderBy("_high").rowsBetween(Window.unboundedPreceding, -1)
    highs = counts.groupBy(*cell, "_high").agg(F.sum("_size").alias("_of_high"))
    starts = highs.withColumn("_start", F.coalesce(F.sum("_of_high").over(over), F.lit(0))).drop("_of_high")
    summed = counts.withColumn("_within", F.coalesce(F.sum("_size").over(within), F.lit(0)))
    return summed.join(starts, [*cell, "_high"]).withColumn("_before", F.col("_within") + F.col("_start")).drop("_high", "_within", "_start")


def positions(df: DataFrame, key: str, seed: int, rows: int, per_group: int = RANKED_KEYS) -> DataFrame:
    """``key`` and ``_position``, from 0 in hash order, of ``rows`` rows. ``key`` must be unique."""
    digits = group_digits(rows, per_group)
    hashed = df.select(key, keyed_hash(seed, key).alias("_hash")).withColumn("_group", hex_to_long(F.col("_hash"), digits))
    counts = hashed.groupBy("_group").agg(F.count(F.lit(1)).alias("_size"))
    offsets = _before(counts, [], "_group", F.shiftright("_group", 2 * digits)).drop("_size")
    rank = F.row_number().over(Window.partitionBy("_group").orderBy("_hash", key)).cast("bigint")
    ranked = hashed.withColumn("_rank", rank).join(offsets, "_group")
    return ranked.select(key, (F.col("_before") + F.col("_rank") - 1).alias("_position"))


def oversample_exact(df: DataFrame, key: str, size: int, seed: int, per_group: int = RANKED_KEYS) -> DataFrame:
    """Exactly ``size`` rows with replacement, numbered by ``draw``; empty in, empty out.

    Each draw is a position; keys alone are ranked to find whose it is, and rows join the draws by key,
    which must be unique.
    """
    spark = df.sparkSession
    total = df.count()
    if not total:
        return df.select(F.lit(0).cast("bigint").alias("draw"), "*").limit(0)
    pick = F.pmod(hex_to_long(keyed_hash(seed, "draw"), 15), F.lit(total))
    draws = spark.range(size).withColumnRenamed("id", "draw").withColumn("_position", pick)
    drawn = draws.join(positions(df, key, seed, total, per_group), "_position").drop("_position")
    return drawn.join(df, key).select("draw", *df.columns)


def sample_to_size(df: DataFrame, key: str, size: int, seed: int) -> DataFrame:
    """Cohort of exactly ``size`` rows: a sample when enough rows exist, else an oversample.

    ``draw`` numbers the copies of an oversample and is null otherwise.
    """
    if df.count() >= size:
        return sample_exact(df, key, size, seed).withColumn("draw", F.lit(None).cast("bigint"))
    return oversample_exact(df, key, size, seed)
