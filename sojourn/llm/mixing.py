"""Operator 4: mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source's rate is the mean number of copies that brings it to its target share. Every document
draws its count by inverting the Poisson distribution of its source's rate at a number hashed from
its id and a seed, is exploded by that count, and all copies are put in one global hashed order.

Cases: a null source is a source of its own; a null id counts as the empty text; rows alike in id
draw alike; rows alike in every column take positions in any order; texts may be null or empty;
extra columns are kept, columns named copy, n_copies or position are replaced; an empty table
gives an empty table. A source without a target weight is left out, its weight being zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage, table

SEED = 20240229
ALPHA = 0.5
#: Copies that one bucket of the global order is meant to hold, and the most buckets there are.
PER_BUCKET = 20_000
MOST_BUCKETS = 65_536


def _source() -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))


def _id() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.lit(""))


def source_rates(docs: DataFrame, weights: dict | None = None, alpha: float = ALPHA, total: int | None = None) -> DataFrame:
    """One row per source: rows, rate, and the Poisson distribution function from 0 until it is 1 in double precision.

    weights: target share by source, in any unit. Without weights a source's target is its row
    count to the power alpha. total: rows wanted in all, as many as there are by default.
    """
    sizes = docs.groupBy(_source().alias("_x_source")).agg(F.count(F.lit(1)).alias("_x_n"))
    if weights is None:
        weighed = sizes.withColumn("_x_weight", F.pow(F.col("_x_n").cast("double"), F.lit(alpha)))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("_x_source") == ("" if name is None else f"s{name}"), F.lit(float(value))).otherwise(weight)
        weighed = sizes.withColumn("_x_weight", weight)
    weighed = stage(weighed, "mix-weights")
    wanted, rows = weighed.agg(F.sum("_x_weight"), F.sum("_x_n")).first()
    scale = float(rows if total is None else total) / wanted if wanted else 0.0
    rated = weighed.withColumn("_x_rate", F.col("_x_weight") * F.lit(scale) / F.col("_x_n"))
    last = F.ceil(F.col("_x_rate") + 12 * F.sqrt("_x_rate") + 30).cast("int")
    start = F.struct((-F.col("_x_rate")).alias("log_p"), F.exp(-F.col("_x_rate")).alias("c"), F.array(F.exp(-F.col("_x_rate"))).alias("all"))

    def step(acc: Column, k: Column) -> Column:
        log_p = acc["log_p"] + F.log("_x_rate") - F.log(k.cast("double"))
        c = acc["c"] + F.exp(log_p)
        return F.struct(log_p.alias("log_p"), c.alias("c"), F.concat(acc["all"], F.array(c)).alias("all"))

    cdf = F.when(F.col("_x_rate") > 0, F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["all"])).otherwise(F.array(F.lit(1.0)))
    return rated.withColumn("_x_cdf", cdf)


def _counted(docs: DataFrame, rates: DataFrame, seed: int) -> DataFrame:
    """docs with _x_count, drawn by inversion at a hashed number in [0, 1)."""
    df = docs.withColumn("_x_doc_source", _source()).join(rates.select("_x_source", "_x_cdf"), F.col("_x_doc_source") == F.col("_x_source"))
    u = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), _id()).cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)
    df = df.withColumn("_x_u", u)
    return df.withColumn("_x_count", F.size(F.filter("_x_cdf", lambda c: c <= F.col("_x_u")))).drop("_x_cdf", "_x_source", "_x_doc_source", "_x_u")


def _exploded(counted: DataFrame, seed: int, buckets: int) -> DataFrame:
    df = counted.where("_x_count > 0").withColumn("_x_copy", F.explode(F.sequence(F.lit(1), F.col("_x_count"))))
    df = df.withColumn("_x_key", F.md5(F.concat(F.lit(f"{seed}:"), _id(), F.lit(":"), F.col("_x_copy").cast("string")).cast("binary")))
    place = F.conv(F.substring("_x_key", 1, 8), 16, 10).cast("long")
    return df.withColumn("_x_bucket", F.floor(place * buckets / F.lit(1 << 32)).cast("int"))


def poisson_mix(docs: DataFrame, weights: dict | None = None, alpha: float = ALPHA, seed: int = SEED, total: int | None = None) -> DataFrame:
    """All columns of docs, with copy (from 1), n_copies and position (gapless from 0 in the global order).

    The rates go out as a stored table of one row per source, broadcast only where Spark finds it
    small. Offsets come from a pass over ids and sources alone; the texts move once, to the bucket
    of the global order that each copy belongs to, whose size is bounded by hashing.
    """
    docs = docs.drop("copy", "n_copies", "position")
    rates = stage(source_rates(docs, weights, alpha, total), "mix-rates")
    copies = rates.agg(F.sum(F.col("_x_rate") * F.col("_x_n"))).first()[0] or 0.0
    buckets = int(min(MOST_BUCKETS, max(1, copies // PER_BUCKET + 1)))
    ids = _exploded(_counted(docs.select("doc_id", "source"), rates, seed), seed, buckets)
    before = Window.orderBy("_x_b").rowsBetween(Window.unboundedPreceding, -1)  # at most MOST_BUCKETS rows
    offsets = ids.groupBy(F.col("_x_bucket").alias("_x_b")).agg(F.count(F.lit(1)).alias("_x_c"))
    offsets = stage(offsets.select("_x_b", F.coalesce(F.sum("_x_c").over(before), F.lit(0)).alias("_x_offset")), "mix-offsets")
    full = _exploded(_counted(docs, rates, seed), seed, buckets)
    ties = [F.col(c) for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))]
    within = Window.partitionBy("_x_bucket").orderBy("_x_key", *ties)
    full = full.withColumn("_x_r", F.row_number().over(within).cast("long") - 1)
    full = full.join(F.broadcast(offsets), F.col("_x_bucket") == F.col("_x_b"))  # at most MOST_BUCKETS small rows
    return full.select(*docs.columns, F.col("_x_copy").alias("copy"), F.col("_x_count").alias("n_copies"), (F.col("_x_r") + F.col("_x_offset")).alias("position"))


def op4_poisson_mix(spark, sf_dir: str) -> DataFrame:
    """Sources mixed to the square root of their sizes, as many rows as before in the mean."""
    return poisson_mix(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars"))


def oracle(alpha: float = ALPHA, seed: int = SEED) -> str:
    """The same result as DuckDB SQL, the distribution function stated by the gamma function."""
    return f"""
WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (SELECT source, (SELECT sum(n) FROM sizes) * pow(n, {alpha}) / (SELECT sum(pow(n, {alpha})) FROM sizes) / n AS rate FROM sizes),
steps AS (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 30)::BIGINT + 1)) AS k FROM rates),
cdf AS (SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS c FROM steps),
lists AS (SELECT source, list(c ORDER BY k) AS cdf FROM cdf GROUP BY source),
drawn AS (
  SELECT d.*, (('0x' || substr(md5('{seed}:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT)::DOUBLE / 4503599627370496.0 AS u, l.cdf
  FROM documents d JOIN lists l ON d.source IS NOT DISTINCT FROM l.source),
counted AS (SELECT * EXCLUDE (u, cdf), len(list_filter(cdf, lambda c: c <= u)) AS n_copies FROM drawn),
copies AS (SELECT *, unnest(range(1, n_copies + 1)) AS copy FROM counted WHERE n_copies > 0)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy, n_copies::INTEGER AS n_copies,
       row_number() OVER (ORDER BY md5('{seed}:' || coalesce(doc_id::VARCHAR, '') || ':' || copy::VARCHAR), doc_id, text, lang, source, n_chars) - 1 AS position
FROM copies
"""
