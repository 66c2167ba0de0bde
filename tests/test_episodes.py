from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sojourn.operators import episodes as E
from sojourn.operators.lines import lines_of_therapy
from sojourn.params import Params

START = dt.date(2020, 1, 1)
PARAMS = Params(observation_end_date=dt.date(2022, 12, 31))
FILL = (
    "patient_id string, fill_date date, fill_seq bigint, drug_name string, provider_id bigint, days_supply int"
)


def day(n):
    return START + dt.timedelta(days=n)


def fills(spark, *rows):
    """Rows are (patient, day number, drug)."""
    made = [(p, day(n), i, drug, 100 + i, 30) for i, (p, n, drug) in enumerate(rows)]
    return spark.createDataFrame(made, FILL)


def index(spark, *patients):
    return spark.createDataFrame([(p, START) for p in patients or ("p",)], "patient_id string, index_date date")


def episodes(spark, *rows, **options):
    df = E.treatment_episodes(fills(spark, *rows), index(spark), PARAMS, **options)
    return df.orderBy("episode_no").collect()


def test_gap_of_exactly_the_limit_stays_and_one_day_more_opens_a_new_episode(spark):
    same = episodes(spark, ("p", 0, "ADT"), ("p", 90, "ADT"))
    assert len(same) == 1 and same[0]["max_refill_gap_days"] == 60
    split = episodes(spark, ("p", 0, "ADT"), ("p", 91, "ADT"))
    assert [(r["episode_no"], r["n_fills"], r["max_refill_gap_days"]) for r in split] == [(1, 1, 0), (2, 1, 0)]


def test_overlapping_fills_keep_the_longest_coverage(spark):
    made = [("p", day(0), 1, "ADT", 1, 200), ("p", day(5), 2, "ADT", 1, 30), ("p", day(220), 3, "ADT", 1, 30)]
    df = E.treatment_episodes(spark.createDataFrame(made, FILL), index(spark), PARAMS)
    row = df.first()
    assert df.count() == 1
    assert (row["covered_until_date"], row["max_refill_gap_days"]) == (day(250), 20)


def test_fill_before_index_or_on_observation_end_is_ignored(spark):
    end = (PARAMS.observation_end_date - START).days
    got = episodes(spark, ("p", -1, "ADT"), ("p", 0, "ADT"), ("p", end, "ADT"))
    assert len(got) == 1 and got[0]["n_fills"] == 1
    assert episodes(spark, ("p", -5, "ADT")) == []


def test_coverage_is_capped_at_observation_end(spark):
    end = (PARAMS.observation_end_date - START).days
    assert episodes(spark, ("p", end - 3, "ADT"))[0]["covered_until_date"] == PARAMS.observation_end_date


def test_grace_extends_coverage_by_the_gap(spark):
    assert episodes(spark, ("p", 0, "ADT"), grace=True)[0]["covered_until_date"] == day(90)


def test_first_other_drug_of_an_episode_on_the_same_day(spark):
    row = episodes(spark, ("p", 0, "ADT"), ("p", 0, "docetaxel"), ("p", 10, "enzalutamide"))[0]
    assert (row["drug_name"], row["other_drug"], row["other_drug_date"]) == ("ADT", "docetaxel", day(0))
    assert row["has_other_drug"] and row["provider_id"] == 100


def test_missing_supply_takes_the_default(spark):
    made = [("p", day(0), 1, "ADT", 1, None)]
    df = E.treatment_episodes(spark.createDataFrame(made, FILL), index(spark), PARAMS)
    assert df.first()["covered_until_date"] == day(30)


def course(spark, *rows, death=None, adverse=None):
    spine = spark.createDataFrame(
        [("p", START, death, adverse)],
        "patient_id string, eligibility_date date, death_date date, adverse_event_date date",
    )
    return E.treatment_history(fills(spark, *rows), spine, PARAMS).orderBy("episode_no").collect()


def test_stop_needs_the_whole_gap_before_censoring(spark):
    last = (PARAMS.observation_end_date - START).days
    kept = course(spark, ("p", 0, "ADT"), ("p", last - 89, "ADT"))
    assert not kept[1]["discontinuation_flag"] and kept[1]["discontinuation_date"] is None
    stopped = course(spark, ("p", 0, "ADT"), ("p", last - 90, "ADT"))
    assert stopped[1]["discontinuation_flag"] and stopped[1]["discontinuation_date"] == day(last - 60)
    dead = course(spark, ("p", 0, "ADT"), death=day(89))
    assert not dead[0]["discontinuation_flag"]
    assert course(spark, ("p", 0, "ADT"), ("p", 400, "ADT"), death=day(90))[0]["discontinuation_flag"]


def test_two_drugs_are_a_switch_and_not_a_stop(spark):
    row = course(spark, ("p", 0, "ADT"), ("p", 20, "docetaxel"), ("p", 900, "ADT"))[0]
    assert row["has_other_drug"] and not row["discontinuation_flag"] and not row["restart_flag"]


def test_restart_needs_the_same_class(spark):
    same = course(spark, ("p", 0, "enzalutamide"), ("p", 200, "apalutamide"))[0]
    assert same["restart_flag"] and same["restart_date"] == day(200) and same["temporary_gap_flag"]
    other = course(spark, ("p", 0, "enzalutamide"), ("p", 200, "docetaxel"))[0]
    assert other["discontinuation_flag"] and not other["restart_flag"] and other["restart_date"] is None


def test_treatment_rows_are_in_order_and_stop_reason_names_the_adverse_event(spark):
    rows = [("p", 0, "ADT"), ("p", 400, "docetaxel"), ("p", 900, "docetaxel")]
    spine = spark.createDataFrame(
        [("p", START, None, day(10))],
        "patient_id string, eligibility_date date, death_date date, adverse_event_date date",
    )
    provider = spark.createDataFrame(
        [(100, "mixed_pathway", "urology")], "provider_id bigint, care_setting string, provider_specialty string"
    )
    history = E.treatment_history(fills(spark, *rows), spine, PARAMS)
    table = E.with_prescriber(E.build_treatments(history, PARAMS), provider)
    assert tuple(table.columns) == E.TREATMENT_COLUMNS
    got = table.orderBy("treatment_line").collect()
    assert [r["treatment_line"] for r in got] == [1, 2, 3]
    assert got[0]["discontinuation_reason"] == "adverse_event"
    assert (got[0]["treatment_setting"], got[1]["treatment_setting"]) == ("mixed_pathway", None)
    for r in got:
        assert r["treatment_end_date"] > r["treatment_start_date"]
        assert r["refill_date"] >= r["treatment_start_date"] and r["covered_until_date"] >= r["refill_date"]


def test_a_switch_adds_a_line_of_the_new_drug(spark):
    rows = [("p", 0, "ADT"), ("p", 20, "docetaxel"), ("p", 30, "ADT"), ("p", 400, "ADT")]
    spine = spark.createDataFrame(
        [("p", START, None, None)],
        "patient_id string, eligibility_date date, death_date date, adverse_event_date date",
    )
    history = E.treatment_history(fills(spark, *rows), spine, PARAMS)
    got = E.build_treatments(history, PARAMS).orderBy("treatment_start_date").collect()
    assert len({r["treatment_id"] for r in got}) == 3
    assert [(r["drug_name"], r["treatment_line"], r["previous_drug"], r["switched_to_drug"]) for r in got] == [
        ("ADT", 1, "ADT", "docetaxel"), ("docetaxel", 2, "ADT", None), ("ADT", 2, None, None)
    ]
    line = got[1]
    assert (line["treatment_start_date"], line["refill_date"], line["drug_class"]) == (day(20), day(20), "chemotherapy")
    assert line["treatment_end_date"] == got[0]["covered_until_date"] and not line["switch_flag"] and not line["restart_flag"]


def test_refill_calendar_lists_every_supply_period(spark):
    table = E.treatment_episodes(fills(spark, ("p", 0, "ADT"), ("p", 45, "ADT")), index(spark), PARAMS)
    got = E.refill_calendar(table, PARAMS).orderBy("refill_no").collect()
    assert [r["expected_refill_date"] for r in got] == [day(0), day(30), day(60)]
    assert {r["expected_fills"] for r in got} == {3} and {r["n_fills"] for r in got} == {2}


def random_fills(spark, seed=3):
    """One patient holds half of all fills, with many on one day."""
    rng = random.Random(seed)
    drugs = ["ADT", "docetaxel", "enzalutamide", None]
    rows = [("hot", day(rng.choice([5, 5, 6, rng.randrange(0, 900)])), i, rng.choice(drugs)) for i in range(400)]
    rows += [(f"p{rng.randrange(40)}", day(rng.randrange(0, 900)), 400 + i, rng.choice(drugs)) for i in range(400)]
    made = [(p, d, rng.randrange(3), drug, seq, rng.choice([10, 30, 90])) for p, d, seq, drug in rows]
    return made


def in_order(row):
    """Day, sequence, drug; a missing one comes first."""
    return row[1], row[2] is not None, row[2] or 0, row[3] is not None, row[3] or ""


def brute_episodes(rows):
    out = set()
    for patient in {r[0] for r in rows}:
        covered, number, current = None, 0, None
        for r in sorted((r for r in rows if r[0] == patient), key=in_order):
            if covered is None or (r[1] - covered).days > PARAMS.allowable_gap_days:
                if current:
                    out.add(tuple(current))
                number += 1
                current = [patient, number, r[3], r[1], r[1], None, 0, None, None]
                gap = 0
            else:
                gap = max(0, (r[1] - covered).days)
            ends = r[1] + dt.timedelta(days=r[5])
            covered = ends if covered is None else max(covered, ends)
            current[4], current[5] = r[1], min(covered, PARAMS.observation_end_date)
            current[6] = max(current[6], gap)
            if r[3] != current[2] and current[7] is None:
                current[7], current[8] = r[1], r[3]
        out.add(tuple(current))
    return out


@pytest.mark.parametrize("partitions", [1, 8, 200])
def test_episodes_equal_brute_force_for_any_partitioning(spark, partitions):
    rows = random_fills(spark)
    patients = sorted({r[0] for r in rows})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        df = spark.createDataFrame(rows, FILL).repartition(5)
        got = E.treatment_episodes(df, index(spark, *patients), PARAMS).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    names = (
        "patient_id", "episode_no", "drug_name", "episode_start_date", "last_fill_date", "covered_until_date",
        "max_refill_gap_days", "other_drug_date", "other_drug",
    )
    assert {tuple(r[n] for n in names) for r in got} == brute_episodes(rows)


def brute_lines(rows):
    out = set()
    for patient in {r[0] for r in rows}:
        lines = []
        for r in sorted((r for r in rows if r[0] == patient), key=in_order):
            ends = r[1] + dt.timedelta(days=r[5])
            if lines and lines[-1]["drug"] == r[3]:
                line = lines[-1]
                line["last"], line["cover"], line["n"] = r[1], max(line["cover"], ends), line["n"] + 1
            else:
                lines.append({"drug": r[3], "start": r[1], "last": r[1], "cover": ends, "n": 1})
        for i, line in enumerate(lines):
            cover = min(line["cover"], PARAMS.observation_end_date)
            after = lines[i + 1] if i + 1 < len(lines) else None
            switch = after is not None and (after["start"] - cover).days <= PARAMS.switch_window_days
            out.add(
                (patient, i + 1, line["drug"], line["start"], line["last"], cover, line["n"], switch,
                 after["start"] if switch else None, after["drug"] if switch else None)
            )
    return out


def lines_of(spark, rows, **options):
    patients = sorted({r[0] for r in rows})
    got = lines_of_therapy(
        spark.createDataFrame(rows, FILL).repartition(3), index(spark, *patients), PARAMS, **options
    ).collect()
    names = (
        "patient_id", "line_no", "drug_name", "line_start_date", "last_fill_date", "covered_until_date", "n_fills",
        "switch_flag", "switch_date", "switched_to_drug",
    )
    assert len(got) == len({(r["patient_id"], r["line_no"]) for r in got})
    return {tuple(r[n] for n in names) for r in got}


@pytest.mark.parametrize("width", [4096, 2, 1])
@pytest.mark.parametrize("limit", [65_536, 30, 0])
def test_lines_equal_brute_force_for_any_slices(spark, width, limit):
    rows = random_fills(spark, seed=8)
    assert lines_of(spark, rows, slice_width=width, patient_limit=limit) == brute_lines(rows)


def test_missing_drugs_are_lines_of_their_own(spark):
    rows = [("p", day(10 * i), i, drug, 1, 30) for i, drug in enumerate(["ADT", None, "ADT", None, "docetaxel"])]
    got = lines_of(spark, rows)
    assert sorted(r[1] for r in got) == [1, 2, 3, 4, 5] and got == brute_lines(rows)


def test_hot_patient_and_hot_day_with_a_sequence_that_grows_with_the_date(spark):
    rng = random.Random(5)
    rows = [("hot", day(5 + i // 300), 7 * i, rng.choice(["ADT", "docetaxel", None]), 1, 30) for i in range(900)]
    rows += [("hot", day(5), rng.choice([None, rng.randrange(10**6)]), "ADT", 1, 30) for _ in range(300)]
    want = brute_lines(rows)
    assert len(want) > 100 and lines_of(spark, rows, slice_width=16) == want
    assert lines_of(spark, rows, slice_width=16, patient_limit=100) == want


def test_lines_scan_fills_once(spark, tmp_path):
    rows = random_fills(spark)
    spark.createDataFrame(rows, FILL).write.parquet(f"{tmp_path}/fills")
    df = lines_of_therapy(spark.read.parquet(f"{tmp_path}/fills"), index(spark, *sorted({r[0] for r in rows})), PARAMS)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1


def test_opening_fill_without_drug_or_provider(spark):
    made = [("p", day(0), 1, "ADT", 9, 30), ("p", day(300), 2, None, None, 30), ("p", day(310), 3, "docetaxel", 7, 30)]
    got = E.treatment_episodes(spark.createDataFrame(made, FILL), index(spark), PARAMS).orderBy("episode_no").collect()
    assert [(r["drug_name"], r["provider_id"], r["other_drug"]) for r in got] == [("ADT", 9, None), (None, None, "docetaxel")]


def test_switch_window_is_inclusive(spark):
    def switch(n):
        df = lines_of_therapy(fills(spark, ("p", 0, "ADT"), ("p", 30 + n, "docetaxel")), index(spark), PARAMS)
        return df.filter("line_no = 1").first()

    assert switch(90)["switch_flag"] and switch(90)["days_to_switch"] == 120
    late = switch(91)
    assert not late["switch_flag"] and late["switch_date"] is None and late["previous_drug"] is None


def test_no_fills_give_no_rows(spark):
    empty = spark.createDataFrame([], FILL)
    assert E.treatment_episodes(empty, index(spark), PARAMS).count() == 0
    assert lines_of_therapy(empty, index(spark), PARAMS).count() == 0


def test_busy_patient_is_folded_before_it_is_grouped(spark):
    """The fold leaves at most (days x drugs) rows of a patient for the windows."""
    busy = spark.range(20000).select(
        F.lit("p").alias("patient_id"),
        F.date_add(F.lit(START), (F.col("id") % 50).cast("int")).alias("fill_date"),
        F.col("id").alias("fill_seq"),
        F.when(F.col("id") % 2 == 0, "ADT").otherwise("docetaxel").alias("drug_name"),
        F.lit(1).cast("bigint").alias("provider_id"),
        F.lit(30).alias("days_supply"),
    )
    assert E.fill_days(busy, PARAMS).count() <= 100
    assert E.treatment_episodes(busy, index(spark), PARAMS).first()["n_fills"] == 20000
