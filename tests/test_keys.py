from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sojourn.operators import keys

D = dt.date


def test_duplicates_count_rows_beyond_the_first_and_nulls_are_equal(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert keys.duplicate_keys(df, ("k",)).first()["failure_count"] == 3


def test_orphans_keep_null_keys(spark):
    child = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), (None,)], "k string")
    assert {tuple(r) for r in keys.orphans(child, "k", parent, "k").collect()} == {("x", 2), (None, 1)}


def test_coverage_gap_lists_each_key_once(spark):
    parent = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    child = spark.createDataFrame([("a",)], "k string")
    assert [r[0] for r in keys.coverage_gap(parent, "k", child, "k").collect()] == ["b"]


def test_census_of_a_heavy_key(spark):
    heavy = spark.range(9000).select(F.lit("h").alias("k")).unionByName(spark.createDataFrame([("b",)], "k string"))
    census = keys.key_census({"x": (heavy, "k"), "y": (spark.createDataFrame([("b",)], "k string"), "k")})
    assert {tuple(r) for r in census.collect()} == {("h", 9000, 0), ("b", 1, 1)}


def test_ordered_pairs_count_what_a_join_would(spark):
    left = [("a", D(2020, 1, i)) for i in (1, 3, 3, 9)] + [("b", D(2020, 1, 5)), (None, D(2020, 1, 5)), ("a", None)]
    right = [("a", D(2020, 1, i)) for i in (3, 4, 8)] + [("b", D(2020, 1, 6)), (None, D(2020, 1, 1))]
    lf, rf = spark.createDataFrame(left, "k string, l date"), spark.createDataFrame(right, "k string, r date")
    joined = lf.join(rf, "k").filter("r <= l").count()
    assert keys.ordered_pairs(lf, "l", rf, "r", "k").first()["pairs"] == joined == 5


def test_events_on_the_terminal_day_are_not_after_it(spark):
    events = spark.createDataFrame(
        [("a", D(2020, 1, 1)), ("a", D(2020, 1, 2)), ("a", D(2020, 1, 2)), ("b", D(2021, 1, 1))], "patient_id string, at date"
    )
    ends = spark.createDataFrame([("a", D(2020, 1, 1)), ("b", None)], "patient_id string, ended date")
    assert [tuple(r) for r in keys.after_terminal(events, "at", ends, "ended").collect()] == [
        ("a", D(2020, 1, 1), 2, D(2020, 1, 2))
    ]
