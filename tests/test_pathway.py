from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sojourn.operators import pathway

EVENT = "patient_id string, event_type string, event_date date"


def d(n):
    return dt.date(2021, 1, 1) + dt.timedelta(days=n)


def test_target_counts_only_on_or_after_the_source(spark):
    rows = [
        ("a", "s", d(10)), ("a", "t", d(4)), ("a", "t", d(30)), ("a", "t", d(12)),
        ("b", "s", d(5)), ("b", "t", d(5)),
        ("c", "s", d(5)), ("c", "t", d(1)),
        ("e", "t", d(1)),
        ("f", "x", d(1)),
    ]
    got = {
        r["patient_id"]: (r["source_date"], r["target_date"], r["referral_completed_flag"], r["referral_delay_days"])
        for r in pathway.referral_pathway(spark.createDataFrame(rows, EVENT), "s", "t").collect()
    }
    assert got == {
        "a": (d(10), d(12), True, 2),
        "b": (d(5), d(5), True, 0),
        "c": (d(5), None, False, None),
        "e": (None, None, False, None),
    }


def test_first_record_takes_one_whole_row_on_ties(spark):
    rows = [("a", d(1), 2, "late", None), ("a", d(1), 1, None, "early"), ("a", d(2), 0, "x", "x")]
    df = spark.createDataFrame(rows, "k string, at date, id int, x string, y string")
    row = pathway.first_record(df, "k", ("at", "id"), ("at", "id", "x", "y")).first()
    assert (row["id"], row["x"], row["y"]) == (1, None, "early")


def test_first_events_in_one_pass(spark):
    rows = [("a", "u", d(3)), ("a", "u", d(1)), ("a", "o", d(9)), ("b", "o", d(2)), ("b", "z", d(0))]
    df = pathway.first_events(spark.createDataFrame(rows, EVENT), {"u": "first_u", "o": "first_o"})
    assert {tuple(r) for r in df.collect()} == {("a", d(1), d(9)), ("b", None, d(2))}


def test_last_event_skips_nulls(spark):
    df = spark.createDataFrame([("a", d(1), None), ("a", None, d(7)), ("b", None, None)], "patient_id string, x date, y date")
    assert {tuple(r) for r in pathway.last_event(df, ("x", "y")).collect()} == {("a", d(7)), ("b", None)}


def test_first_dates_start_at_the_index_and_bring_their_detail(spark):
    rows = [
        ("a", "bad", d(1), "early"), ("a", "bad", d(6), "z"), ("a", "bad", d(5), "k"), ("a", "bad", d(5), "j"),
        ("a", "end", d(5), None), ("b", "end", d(0), None),
    ]
    events = spark.createDataFrame(rows, EVENT + ", event_detail string")
    index = spark.createDataFrame([("a", d(5)), ("b", d(5)), ("c", d(5))], "patient_id string, i date")
    got = pathway.attach_first_dates(index, events, "i", {"bad": "bad_date", "end": "end_date"}, {"bad": "kind"})
    assert {(r["patient_id"], r["bad_date"], r["kind"], r["end_date"]) for r in got.collect()} == {
        ("a", d(5), "j", d(5)), ("b", None, None, None), ("c", None, None, None),
    }


def test_encounters_are_two_or_three_rows(spark):
    visits = spark.createDataFrame(
        [(1, d(0), d(3), d(9)), (2, d(0), d(3), None), (3, d(0), None, None)],
        "patient_id bigint, diagnosis_date date, source_date date, target_date date",
    )
    assigned = spark.createDataFrame(
        [(1, 7, "ORG-2", "mixed_pathway")],
        "patient_id bigint, provider_id bigint, organization_id string, care_setting string",
    )
    table = pathway.with_visited_provider(pathway.build_encounters(visits), assigned)
    assert tuple(table.columns) == pathway.ENCOUNTER_COLUMNS
    rows = {r["encounter_id"]: r for r in table.collect()}
    assert sorted(rows) == [
        "ENC-00000001-0", "ENC-00000001-1", "ENC-00000001-2", "ENC-00000002-0", "ENC-00000002-1", "ENC-00000003-0",
    ]
    assert rows["ENC-00000001-1"]["referral_flag"] and rows["ENC-00000001-1"]["referral_completion_date"] == d(9)
    assert not rows["ENC-00000002-1"]["referral_flag"] and rows["ENC-00000002-1"]["referral_date"] is None
    assert rows["ENC-00000001-2"]["encounter_type"] == "oncology_consultation"
    assert rows["ENC-00000002-0"]["provider_id"] is None and rows["ENC-00000001-0"]["provider_id"] == 7


def test_event_log_unions_typed_rows_and_drops_null_dates(spark):
    a = spark.createDataFrame([(1, d(1)), (1, None)], "pid int, at date")
    b = spark.range(2).select(F.col("id").alias("who"), F.lit(d(2)).alias("on"))
    log = pathway.event_log({"a": (a, "pid", "at"), "b": (b, "who", "on")})
    assert log.columns == ["patient_id", "event_type", "event_date"]
    assert sorted(tuple(r) for r in log.collect()) == [(0, "b", d(2)), (1, "a", d(1)), (1, "b", d(2))]
