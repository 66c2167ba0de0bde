"""Operator 3: sharding along a Hilbert curve, in DataFrame functions only.

Several metadata dimensions are quantised to levels, the levels give a cell of a Hilbert curve,
documents are ordered by curve index, and the order is cut into runs whose row counts differ by at
most one (law ``rows``). Files of one run then span few levels of every dimension, so that filters
on any of them prune files.

Cases: a null dimension lies below all values; a null text has no bytes; documents of one cell, be
they copies or not, follow each other in hashed order; fewer rows than shards leave shards empty;
extra columns are kept, columns named shard or slot are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ranked, stage, table, text_or_empty

SHARDS = 16
BITS = 4
DIMENSIONS = ("lang", "source", "size", "doc_id")


def curve_table(n: int) -> tuple[list[int], list[int]]:
    """State machine of the n-dimensional curve: for state * 2**n + corner, the digit and the next state.

    A state is an entry corner and a direction (Hamilton 2006); digits are corners put in Gray order.
    """
    full = (1 << n) - 1
    right = lambda x, r: ((x >> r % n) | (x << (n - r % n))) & full
    left = lambda x, r: right(x, n - r % n)
    ones = lambda i: ((i + 1) & -(i + 1)).bit_length() - 1  # noqa: E731  trailing ones

    def entry(i: int) -> int:
        j = 2 * ((i - 1) // 2)
        return 0 if i == 0 else j ^ (j >> 1)

    def direction(i: int) -> int:
        return 0 if i == 0 else ones(i - 1 if i % 2 == 0 else i) % n

    digits, states = [], []
    for state in range(n << n):
        d, e = divmod(state, 1 << n)
        for corner in range(1 << n):
            gray, w = right(corner ^ e, d + 1), 0
            while gray:
                w, gray = w ^ gray, gray >> 1
            digits.append(w)
            states.append(((d + direction(w) + 1) % n << n) + (e ^ left(entry(w), d + 1)))
    return digits, states


def curve_index(levels: list[Column], bits: int = BITS) -> Column:
    """Index on the curve of the cell with these levels, each from 0 to 2**bits - 1."""
    n = len(levels)
    digits, states = (F.array(*[F.lit(x) for x in xs]) for xs in curve_table(n))
    corners = []
    for bit in reversed(range(bits)):
        corner = F.lit(0)
        for i, level in enumerate(levels):
            corner = corner.bitwiseOR(F.shiftleft(F.shiftright(level, bit).bitwiseAND(1), i))
        corners.append(corner)
    place = lambda acc, corner: F.shiftleft(acc["state"], n) + corner
    return F.aggregate(
        F.array(*corners),
        F.struct(F.lit(0).alias("state"), F.lit(0).alias("index")),
        lambda acc, corner: F.struct(F.get(states, place(acc, corner)).alias("state"), (F.shiftleft(acc["index"], n) + F.get(digits, place(acc, corner))).alias("index")),
        lambda acc: acc["index"],
    )


def text_limits(df: DataFrame, name: str, cuts: list[float]) -> list[str]:
    """For each cut the least value of a text column up to which at least that share of rows with a value lies.

    Values are counted and dealt to ranges, and a running sum goes over ranges and within each, so no
    task sees all values; len(cuts) texts reach the driver.
    """
    spark = df.sparkSession
    counts = df.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = stage(counts.repartitionByRange(ranges, "value").withColumn("range", F.spark_partition_id()), "text-values")
    so_far = Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = dealt.groupBy("range").agg(F.sum("n").alias("of_range"), F.min("value").alias("first"))
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = ends.select(F.col("range").alias("_range"), F.coalesce(F.sum("of_range").over(before), F.lit(0)).alias("start"))
    running = dealt.withColumn("within", F.sum("n").over(so_far)).join(F.broadcast(starts), F.col("range") == F.col("_range"))
    total = dealt.agg(F.sum("n")).scalar()
    at = F.col("start") + F.col("within")
    row = running.agg(*[F.min(F.when(at >= cut * F.coalesce(total, F.lit(0)), F.col("value"))).alias(f"l{i}") for i, cut in enumerate(cuts)]).first()
    return [x for x in row if x is not None]


def hilbert_shards(df: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """All columns of df, with shard (from 0) and slot (gapless from 0 within the shard).

    Level limits are quantiles over all rows, at most 2**bits - 1 values for each dimension; those of
    a text column come from its counted values, whole.
    Ranks come from counted buckets (see ranked), so neither a cell nor a shard is held by a task.
    """
    df = df.drop("shard", "slot")
    at = [f"_x_d{i}" for i in range(len(dimensions))]
    texts = {a for a, d in zip(at, dimensions, strict=True) if dict(df.dtypes)[d] == "string"}
    df = df.withColumns({a: F.col(d) if a in texts else F.col(d).cast("double") for a, d in zip(at, dimensions, strict=True)})
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(a, cuts, 10_000).alias(a) for a in at if a not in texts], F.count(F.lit(1)).alias("n")).first()
    rows, limits = found["n"], {a: text_limits(df, a, cuts) if a in texts else found[a] for a in at}
    levels = {}
    for a in at:
        level = F.lit(0)
        for limit in sorted(set(limits[a] or [])):
            level = level + F.when(F.col(a) > F.lit(limit), 1).otherwise(0)
        levels[a] = level.cast("int")
    df = df.withColumns(levels).withColumn("_x_cell", curve_index([F.col(a) for a in at], bits)).drop(*at)

    half = bits * len(dimensions) // 2
    cells = df.groupBy("_x_cell").agg(F.count(F.lit(1)).alias("_x_n")).withColumn("_x_high", F.shiftright("_x_cell", half))
    before = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    high = cells.groupBy(F.col("_x_high").alias("_x_h")).agg(F.sum("_x_n").alias("_x_hn"))
    high = high.select("_x_h", F.coalesce(F.sum("_x_hn").over(before("_x_h")), F.lit(0)).alias("_x_h_start"))
    starts = cells.withColumn("_x_low_start", F.coalesce(F.sum("_x_n").over(before("_x_high", "_x_cell")), F.lit(0)))
    starts = starts.join(F.broadcast(high), F.col("_x_high") == F.col("_x_h"))  # at most 2**(bits * dimensions / 2) rows
    starts = starts.select(F.col("_x_cell").alias("_x_c"), (F.col("_x_low_start") + F.col("_x_h_start")).alias("_x_start"))

    order = [c for c, kind in df.dtypes if c != "_x_cell" and not kind.startswith(("map", "variant"))]
    placed = ranked(df, "_x_cell", order, "_x_rank")
    placed = placed.join(starts, F.col("_x_cell") == F.col("_x_c")).withColumn("_x_place", F.col("_x_rank") + F.col("_x_start"))
    size, more = divmod(rows, shards)
    edge = more * (size + 1)
    place = F.col("_x_place")
    small = place - edge
    shard = F.when(place < edge, F.floor(place / (size + 1)))
    slot = F.when(place < edge, place % (size + 1))
    if size:
        shard, slot = shard.otherwise(more + F.floor(small / size)), slot.otherwise(small % size)
    return placed.withColumns({"shard": shard.cast("int"), "slot": slot.cast("long")}).drop("_x_cell", "_x_c", "_x_rank", "_x_start", "_x_place")


def op3_hilbert_shards(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    body = text_or_empty().cast("binary")
    lean = docs.select("doc_id", "lang", "source", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    out = hilbert_shards(stage(lean, "shard-rows"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "lang", "source")
