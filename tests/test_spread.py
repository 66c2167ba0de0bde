from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sojourn.operators import episodes
from sojourn.sources import files, roles

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["lines_of_therapy", "event_log"])
def test_tasks_grow_with_the_input(spark, monkeypatch, name):
    """A task of a wide step takes a bounded share of the input, and no result depends on how many tasks there are."""
    query = entry.queries()[name]
    rows = sorted(map(str, query(spark, SF).collect()))
    per_task = 1 << 12
    monkeypatch.setattr(files, "INPUT_PER_TASK", per_task)
    wide = query(spark, SF)
    assert sorted(map(str, wide.collect())) == rows
    paths = [f"{SF}/{table}.parquet" for table in ("lineitem", "orders", "part")]
    least = sum(files._hadoop_path(spark, p)[1].getFileStatus(files._hadoop_path(spark, p)[0]).getLen() for p in paths) // per_task
    assert wide.rdd.getNumPartitions() >= least > 4


def test_many_fills_move_once(spark, monkeypatch, tmp_path):
    """Large inputs are dealt by patient before they are folded; no step after the fold deals them anew, and the rows stay the same."""
    path = str(tmp_path / "fills.parquet")
    roles.fills(spark, SF).withColumn("patient_id", F.when(F.col("fill_seq") % 3 == 0, 5).otherwise(F.col("patient_id"))).write.parquet(path)
    fills, index = spark.read.parquet(path), roles.diagnoses(spark, SF).selectExpr("patient_id", "diagnosis_date AS index_date")

    def found():
        return episodes.treatment_episodes(fills, index, roles.BOUND)

    rows = sorted(map(str, found().collect()))
    monkeypatch.setattr(files, "INPUT_PER_TASK", 1 << 12)
    wide = found()
    assert sorted(map(str, wide.collect())) == rows
    plan = wide._jdf.queryExecution().sparkPlan().toString() + wide._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(patient_id" in plan and not re.search(r"hashpartitioning\(patient_id#\d+L, fill_date", plan)
    assert wide.rdd.getNumPartitions() > 4


def test_a_small_input_is_left_as_it_is(spark):
    table = spark.read.parquet(f"{SF}/orders.parquet")
    assert files.task_count(table) == 4 and files.spread(table, "o_custkey") is table
    assert files.task_count(table, 1 << 10) > 4
