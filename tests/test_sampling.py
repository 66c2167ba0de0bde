from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sojourn.functions.expr import keyed_hash
from sojourn.operators.sampling import oversample_exact, positions, sample_exact, sample_to_size


def numbers(spark, n):
    return spark.range(n).withColumn("v", F.col("id") * 3)


@pytest.mark.parametrize("size", [1, 37, 999, 1000, 5000])
def test_sample_equals_ordering_by_hash_and_taking_the_first(spark, size):
    df = numbers(spark, 1000)
    expected = df.orderBy(keyed_hash(9, "id"), "id").limit(size)
    got = sample_exact(df, "id", size, 9)
    assert got.count() == min(size, 1000)
    assert sorted(got.collect()) == sorted(expected.collect())


def test_sample_ignores_partitioning(spark):
    df = numbers(spark, 3000)
    assert sample_exact(df, "id", 250, 1).exceptAll(sample_exact(df.repartition(11), "id", 250, 1)).count() == 0


@pytest.mark.parametrize("per_group", [1, 40, 50_000])
def test_the_cut_is_found_at_any_depth(spark, per_group):
    df = numbers(spark, 5000)
    for size in (1, 1234, 4999):
        expected = df.orderBy(keyed_hash(9, "id"), "id").limit(size)
        assert sorted(sample_exact(df, "id", size, 9, per_group).collect()) == sorted(expected.collect())
    assert sample_exact(df, "id", 0, 9).count() == 0


def test_a_key_on_many_rows_does_not_swell_the_sample(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2000, F.lit(7)).otherwise(F.col("id")).alias("id"), F.lit("x").alias("v"))
    assert [sample_exact(df, "id", size, 4, 10).count() for size in (1, 700, 2500, 3000)] == [1, 700, 2500, 3000]


def test_a_sample_ranks_no_whole_rows(spark):
    plan = sample_exact(numbers(spark, 2000), "id", 500, 1)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "TakeOrderedAndProject" in plan


@pytest.mark.parametrize(("rows", "per_group"), [(1, 50_000), (1000, 3), (4000, 50_000)])
def test_positions_are_dense_in_hash_order(spark, rows, per_group):
    df = numbers(spark, rows)
    got = {r["id"]: r["_position"] for r in positions(df, "id", 4, rows, per_group).collect()}
    assert got == {r["id"]: i for i, r in enumerate(df.orderBy(keyed_hash(4, "id"), "id").collect())}


def test_oversample_draws_exactly_and_only_from_the_rows(spark):
    drawn = oversample_exact(numbers(spark, 7), "id", 500, 3).collect()
    assert sorted(r["draw"] for r in drawn) == list(range(500))
    assert {r["id"] for r in drawn} == set(range(7))


def test_oversample_of_nothing_is_nothing(spark):
    assert oversample_exact(numbers(spark, 0), "id", 10, 3).count() == 0


def test_sample_to_size_chooses_by_count(spark):
    assert sample_to_size(numbers(spark, 50), "id", 20, 1).select("id").distinct().count() == 20
    assert sample_to_size(numbers(spark, 5), "id", 20, 1).count() == 20
