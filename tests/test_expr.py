from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sojourn.functions import expr


def one(spark, column, **values):
    ddl = {str: "string", int: "bigint", bool: "boolean", dt.date: "date", type(None): "bigint"}
    schema = ", ".join(f"{k} {ddl[type(v)]}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


def test_clamp_keeps_null_where_plain_greatest_would_not(spark):
    assert one(spark, expr.clamp(F.col("v"), 1, 5), v=None) is None
    assert one(spark, F.greatest(F.col("v"), F.lit(1)), v=None) == 1
    assert [one(spark, expr.clamp(F.col("v"), 1, 5), v=v) for v in (-3, 3, 9)] == [1, 3, 5]


def test_latest_date_skips_nulls(spark):
    df = spark.sql("SELECT DATE'2020-01-01' AS a, CAST(NULL AS DATE) AS b, DATE'2020-03-01' AS c")
    assert df.select(F.greatest("a", "b", "c").alias("x")).first()["x"] == dt.date(2020, 3, 1)


def test_two_ages_differ_at_the_upper_bound(spark):
    birth, index = dt.date(1931, 1, 20), dt.date(2022, 1, 1)
    df = spark.createDataFrame([(birth, index)], "b date, i date")
    row = df.select(
        expr.floored_age(F.col("i"), F.col("b")).alias("f"), expr.rounded_age(F.col("i"), F.col("b")).alias("r")
    ).first()
    days = (index - birth).days
    assert row["f"] == days // 365 and row["r"] == round(days / 365.25)


def test_days_count_calendar_boundaries(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2020-01-02 01:00' AS e, TIMESTAMP_NTZ'2020-01-01 23:00' AS s")
    assert df.select(expr.days_between("e", "s").alias("x")).first()["x"] == 1


def test_band_sends_null_to_the_top_band(spark):
    assert one(spark, expr.age_band(F.col("v")), v=None) == "75+"
    assert [one(spark, expr.age_band(F.col("v")), v=v) for v in (64, 65, 74, 75)] == ["<65", "65-74", "65-74", "75+"]
    assert [one(spark, expr.burden_band(F.col("v")), v=v) for v in (1, 2, 3, 4)] == ["low", "medium", "medium", "high"]


def test_surrogate_key_pads_and_never_truncates(spark):
    assert one(spark, expr.surrogate_key("PJ", F.col("v")), v=42) == "PJ-00000042"
    assert one(spark, expr.surrogate_key("PJ", F.col("v")), v=12345678901) == "PJ-12345678901"
    assert one(spark, expr.surrogate_key("TR", F.col("v"), F.lit(1)), v=7) == "TR-00000007-1"


def test_lenient_date_gives_null_for_bad_text(spark):
    df = spark.createDataFrame([("1955-06-01",), ("unknown",), ("2020-13-40",), (None,)], "t string")
    got = [r["d"] for r in df.select(expr.lenient_date(df, F.col("t")).alias("d")).collect()]
    assert got == [dt.date(1955, 6, 1), None, None, None]


def test_resolve_ignores_case_and_takes_defaults(spark):
    df = spark.createDataFrame([("x",)], "birthdate string")
    assert df.select(expr.resolve(df, ["BIRTHDATE"]).alias("v")).first()["v"] == "x"
    assert df.select(expr.resolve(df, ["ZIP"], F.lit("d")).alias("v")).first()["v"] == "d"
    assert df.select(expr.resolve(df, ["ZIP"]).alias("v")).first()["v"] is None


def test_literal_map_is_null_for_unknown_keys(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    got = [r["v"] for r in df.select(expr.literal_map({"a": "it's"}, "k").alias("v")).collect()]
    assert got == ["it's", None, None]


def test_weighted_bucket_follows_weights_and_is_stable(spark):
    weights = {"a": 0.5, "b": 0.3, "c": 0.2}
    df = spark.range(20000).select("id", expr.weighted_bucket("id", 5, weights).alias("g"))
    share = {r["g"]: r["count"] / 20000 for r in df.groupBy("g").count().collect()}
    assert all(abs(share[k] - w) < 0.02 for k, w in weights.items())
    assert df.exceptAll(df.repartition(7)).count() == 0
