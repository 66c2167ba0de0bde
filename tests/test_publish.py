from __future__ import annotations

import dataclasses
import datetime as dt
import os
import threading
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sojourn.operators.episodes import TREATMENT_COLUMNS
from sojourn.params import TABLES, Params
from sojourn.plans import catalog, publish, quality, serving, timeline
from sojourn.sources import files, roles, versions

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def observed(spark):
    return roles.observed(spark, SF_DIR)


@pytest.fixture(scope="module")
def tables(spark, observed):
    return publish.build_tables(observed, roles.BOUND, files.new_stage(spark))


def test_stage_folder_is_the_one_the_session_names(spark):
    assert files.new_stage(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert files.new_stage(spark) != files.new_stage(spark)


def test_seven_tables_with_their_published_columns(tables):
    assert tuple(tables) == TABLES
    widths = {"patient": 20, "diagnosis": 19, "provider": 9, "encounter": 15, "treatment": 26, "outcome": 15, "patient_journey": 65}
    assert {name: len(df.columns) for name, df in tables.items()} == widths
    assert tuple(tables["treatment"].columns) == TREATMENT_COLUMNS


def test_one_plan_journey_equals_the_journey_from_tables(observed, tables):
    whole = publish.observed_journey(observed, roles.BOUND)
    joined = tables["patient_journey"].select(*timeline.JOURNEY_COLUMNS)
    assert whole.exceptAll(joined).count() == 0 and joined.exceptAll(whole).count() == 0


def test_lazy_queries_equal_staged_tables(spark, tables):
    for name, query in (("encounter", catalog.encounter), ("treatment", catalog.treatment), ("outcome", catalog.outcome_status)):
        lazy = query(spark, SF_DIR).select(*tables[name].columns)
        assert lazy.exceptAll(tables[name]).count() == 0
        assert lazy.count() == tables[name].count()


def presentable(observed):
    """Inputs that pass every critical rule: nobody dies, everybody has a provider."""
    living = observed.clinical.filter("event_type <> 'death'")
    matched = observed.assignment.withColumn("provider_id", F.coalesce("provider_id", F.lit(0)))
    return dataclasses.replace(observed, clinical=living, assignment=matched)


def test_publish_then_load(spark, observed, tmp_path):
    gold = str(tmp_path / "gold")
    run = publish.publish(spark, presentable(observed), roles.BOUND, gold, formats=("parquet", "csv"))
    loaded = publish.load_published(spark, gold)
    assert tuple(loaded) == TABLES
    assert loaded["patient_journey"].filter("patient_id LIKE 'PJ-0%'").count() == 150
    for name in TABLES:
        assert (tmp_path / "gold" / "runs" / run.rsplit("/", 1)[1] / f"{name}.csv").exists()
    rules = files.read_csv_table(spark, f"{run}/reports/data_quality_summary.csv")
    assert rules.count() == len(quality.RULES) + len(quality.EXTRA_RULES)
    assert spark.read.json(f"{run}/reports/data_quality_summary.json").count() == rules.count()
    assert spark.read.json(f"{run}/reports/data_quality_verdict.json").first()["verdict"] == "publish"
    prints = files.read_csv_table(spark, f"{run}/reports/output_fingerprints.csv").collect()
    assert {r["table_name"] for r in prints} == set(TABLES)
    assert {r["n_rows"] for r in prints if r["table_name"] in ("patient", "outcome")} == {"150"}
    kpi = files.read_csv_table(spark, f"{run}/reports/cohort_kpis.csv")
    assert kpi.count() == 18 and kpi.filter("kpi = 'total_patients'").first()["value"] == "150"


def test_a_critical_failure_holds_the_run_back(spark, observed, tmp_path):
    gold = str(tmp_path / "gold")
    good = publish.publish(spark, presentable(observed), roles.BOUND, gold)
    doubled = dataclasses.replace(observed, patient=observed.patient.unionByName(observed.patient.limit(1)))
    with pytest.raises(quality.CriticalQualityFailure, match="patient_unique"):
        publish.publish(spark, doubled, roles.BOUND, gold)
    assert [versions.run_of(spark, gold, v) for v in versions.versions(spark, gold)] == [good]


def test_of_two_publishers_at_once_one_wins(spark, observed, tmp_path):
    gold, both = str(tmp_path / "gold"), threading.Barrier(2)

    def attempt(_):
        try:
            return publish.publish(spark, presentable(observed), roles.BOUND, gold, gate=lambda results: both.wait(300))
        except versions.PublishConflict:
            return None

    with ThreadPoolExecutor(2) as pool:
        runs = list(pool.map(attempt, range(2)))
    (winner,) = [r for r in runs if r is not None]
    assert versions.versions(spark, gold) == [1] and publish.published_run(spark, gold) == winner
    assert len(list((tmp_path / "gold" / "runs").iterdir())) == 2
    after = publish.publish(spark, presentable(observed), roles.BOUND, gold)
    assert versions.versions(spark, gold) == [1, 2] and publish.published_run(spark, gold) == after


def test_a_version_is_created_once(spark, tmp_path):
    path = str(tmp_path / "versions" / "000000000001")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: versions.create_once(spark, path, f"run {i}\n"), range(24)))
    assert won.count(True) == 1
    assert versions.read_text(spark, path) == f"run {won.index(True)}\n"
    assert [p.name for p in (tmp_path / "versions").iterdir() if not p.name.startswith(".")] == ["000000000001"]
    assert versions.versions(spark, str(tmp_path)) == [1] and versions.latest(spark, str(tmp_path / "absent")) == 0
    with pytest.raises(FileNotFoundError):
        publish.published_run(spark, str(tmp_path / "absent"))


def test_each_table_is_written_once_and_nothing_stays_behind(spark, observed, tmp_path, monkeypatch):
    written, put = [], files.write_parquet_table
    monkeypatch.setattr(files, "write_parquet_table", lambda df, path: (written.append(path.rsplit("/", 1)[1]), put(df, path)))
    root = files.stage_root(spark)
    before = set(os.listdir(f"{root}/sojourn"))
    run = publish.publish(spark, presentable(observed), roles.BOUND, str(tmp_path / "gold"))
    assert all(written.count(f"{name}.parquet") == 1 for name in TABLES)
    assert not [name for name in os.listdir(run) if name.startswith("_")]
    assert set(os.listdir(f"{root}/sojourn")) == before


def test_ranges_roll_up_to_the_table_and_name_what_changed(spark):
    df = spark.range(3000).withColumn("text", F.when(F.col("id") % 7 > 0, F.col("id").cast("string"))).withColumn("x", F.col("id") / 7)
    leaves = serving.range_fingerprints(df, "id")
    assert leaves.count() == 256
    assert serving.roll_up(leaves).first().asDict() == serving.table_fingerprint(df).first().asDict()
    named = lambda frame: serving.range_fingerprints(frame, "id").select(F.lit("t").alias("table_name"), "*")
    where = F.substring(F.md5(F.col("id").cast("string")), 1, 2)
    other = df.withColumn("text", F.when(F.col("id") == 5, "new").otherwise(F.col("text"))).filter("id <> 9").unionByName(df.filter("id = 11"))
    expected = {r["r"] for r in df.filter("id IN (5, 9, 11)").select(where.alias("r")).collect()}
    assert {r["key_range"] for r in serving.changed_ranges(named(df), named(other)).collect()} == expected
    assert serving.changed_ranges(named(df), named(df.repartition(7))).count() == 0
    lost = serving.changed_ranges(named(df), named(df.filter(where != "00"))).first()
    assert lost["key_range"] == "00" and lost["rows_after"] == 0 < lost["rows_before"]
    none = publish.fingerprints(publish.fingerprint_leaves({"patient": df.withColumnRenamed("id", "patient_id").limit(0)}), ["patient"]).first()
    assert tuple(none) == ("patient", 0, 0, 0)


def test_nanosecond_dates_are_read_by_their_physical_schema(spark, tables, tmp_path):
    moments = [dt.datetime(1969, 12, 31, 23, 59, 59), dt.datetime(1970, 1, 1), dt.datetime(2024, 2, 29), None]
    nanos = pa.array(moments, pa.timestamp("ns"))
    pq.write_table(pa.table({"patient_id": ["a", "b", "c", "d"], "death_date": nanos, "censor_date": pa.array(moments, pa.timestamp("us")), "days": pa.array([1, 2, 3, None])}), str(tmp_path / "outcome.parquet"))
    pq.write_table(pa.table({"patient_id": ["a"], "birth_date": pa.array([dt.date(1950, 5, 1)]), "date_of_death": nanos.slice(2, 1)}), str(tmp_path / "patient.parquet"))
    loaded = files.load_exported_tables(spark, str(tmp_path), ["outcome", "patient"])
    days = [m.date() if m else None for m in moments]
    assert [(r["death_date"], r["censor_date"], r["days"]) for r in loaded["outcome"].orderBy("patient_id").collect()] == list(zip(days, days, [1, 2, 3, None], strict=True))
    assert tuple(loaded["patient"].first()) == ("a", dt.date(1950, 5, 1), dt.date(2024, 2, 29))
    files.export_tables({"outcome": tables["outcome"]}, str(tmp_path / "own"), ["parquet"])
    again = files.load_exported_tables(spark, str(tmp_path / "own"), ["outcome"])["outcome"]
    assert again.schema == tables["outcome"].schema and again.exceptAll(tables["outcome"]).count() == 0


def test_no_fills_at_all(spark, observed):
    empty = dataclasses.replace(observed, fills=observed.fills.limit(0))
    journey = publish.observed_journey(empty, roles.BOUND)
    row = journey.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.expr("treatment_initiated OR persistent_3m OR initiated_within_90d")).alias("treated"),
        F.count_if(F.expr("final_outcome_status IN ('active_treatment', 'switched', 'restarted')")).alias("status"),
    ).first()
    assert (row["n"], row["treated"], row["status"]) == (150, 0, 0)


def test_csv_round_trip_keeps_dates_and_types(spark, tables, tmp_path):
    path = str(tmp_path / "outcome.csv")
    files.write_csv_table(tables["outcome"], path)
    again = files.read_csv_table(spark, path, tables["outcome"].schema)
    assert again.exceptAll(tables["outcome"]).count() == 0 and again.count() == tables["outcome"].count()


def test_export_and_load_by_name(spark, tables, tmp_path):
    small = {name: tables[name] for name in ("patient", "outcome")}
    files.export_tables(small, str(tmp_path))
    loaded = files.load_exported_tables(spark, str(tmp_path), small)
    assert {name: df.count() for name, df in loaded.items()} == {"patient": 150, "outcome": 150}


def test_views_answer_sql(spark, tables):
    serving.register_tables(tables)
    journey = tables["patient_journey"]
    assert spark.table("vw_eligible_population").count() == journey.filter("eligible_for_arpi").count()
    top = spark.sql("SELECT * FROM vw_treatment_gap_by_segment ORDER BY treatment_gap DESC LIMIT 20")
    assert top.columns[-3:] == ["eligible", "initiated_90d", "treatment_gap"]
    totals = spark.sql("SELECT sum(eligible) e, sum(initiated_90d) i, sum(treatment_gap) g FROM vw_treatment_gap_by_segment").first()
    assert totals["e"] == totals["i"] + totals["g"]
    assert spark.table("vw_switches").filter("NOT switch_flag OR switch_flag IS NULL").count() == 0


def test_fingerprint_ignores_order_and_notices_changes(spark):
    columns = ("id", "text")
    df = spark.range(500).withColumn("text", F.when(F.col("id") % 7 > 0, F.col("id").cast("string")))
    first = serving.table_fingerprint(df, columns).first()
    assert first == serving.table_fingerprint(df.repartition(9).orderBy(F.desc("id")), columns).first()
    changed = df.withColumn("text", F.when(F.col("id") == 3, "x").otherwise(F.col("text")))
    assert first != serving.table_fingerprint(changed, columns).first()
    assert serving.table_fingerprint(df.limit(0), columns).first()["n_rows"] == 0


def test_fingerprint_tells_like_rows_apart(spark):
    def prints(*rows):
        frame = spark.createDataFrame(list(rows), "a string, b string, x double")
        return serving.table_fingerprint(frame).first()

    rows = [("a|b", "c", 1.0), ("a", "b|c", 1.0), (None, "c", 1.0), ("\\N", "c", 1.0), ("", "c", 1.0), ("a", "b|c", 2.0), ("a", "b|c", None)]
    rows += [("a", "b|c", 1.0000000000000002), ("a", "b|c", float("nan")), ("a", "b|c", float("inf")), ("a", "b|c", 1e300)]
    assert len({prints(r) for r in rows}) == len(rows)
    assert prints(rows[0], rows[1]) == prints(rows[1], rows[0]) != prints(rows[0], rows[0])


def test_params_are_checked():
    with pytest.raises(ValueError):
        Params(target_cohort_size=0)
    with pytest.raises(ValueError):
        Params(minimum_age=91)


def test_fingerprint_tells_small_and_long_doubles_apart(spark):
    values = [0.0, 1e-20, 2e-20, 0.0012345678901234567, 0.0012345678901234569, 1e30, 0.5, None]
    prints = [serving.table_fingerprint(spark.createDataFrame([(v,)], "x double")).first() for v in values]
    assert len(set(prints)) == len(values)


def test_sql_over_bucketed_tables_moves_no_patient(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        summary = catalog.sql_patient_summary(spark, SF_DIR)
        assert summary.count() == 150
        summary.collect()
        plan = summary._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "Exchange" not in plan and plan.count("Bucketed: true") >= 6
    assert {r["tableName"] for r in spark.sql("SHOW TABLES").collect()} >= {*TABLES, "vw_switches"}


@pytest.mark.parametrize("name", ["sql_patient_summary", "sql_provider_summary"])
def test_sql_tables_are_written_once(spark, monkeypatch, name):
    """No table is staged first and then copied into buckets; there are more buckets if there is more input."""
    staged, saved, write, bucket = [], {}, files.stage_table, files.bucket_table
    monkeypatch.setattr(publish, "stage_table", lambda df, directory, table: staged.append(table) or write(df, directory, table))
    monkeypatch.setattr(publish, "bucket_table", lambda df, directory, table, *rest: saved.update({table: rest}) or bucket(df, directory, table, *rest))
    monkeypatch.setattr(files, "INPUT_PER_TASK", 1 << 14)
    rows = getattr(catalog, name)(spark, SF_DIR).collect()
    assert rows and sorted(saved) == sorted(TABLES) and not set(staged) & set(TABLES)
    assert {key for key, _ in saved.values()} == {"patient_id", "provider_id"} and min(n for _, n in saved.values()) > 4


def test_runs_over_staged_inputs_read_the_sources_once(spark, observed):
    """Tables made from staged inputs equal those made from the sources, and no line items or events are read again."""
    staged = publish.staged_inputs(observed, roles.BOUND, files.new_stage(spark))
    for name in ("days", "diagnosis", "assignment", "clinical", "visits"):
        assert not [f for f in getattr(staged, name).inputFiles() if "testdata" in f]
    broken = dataclasses.replace(staged, fills=None)
    ours, theirs = (publish.build_tables(o, roles.BOUND, files.new_stage(spark)) for o in (broken, observed))
    for name in ("treatment", "outcome", "patient_journey"):
        assert sorted(map(str, ours[name].collect())) == sorted(map(str, theirs[name].collect())) != []
