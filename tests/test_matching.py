from __future__ import annotations

import hashlib

import pytest

from sojourn.operators.matching import match_with_fallback
from sojourn.sources import roles

SUBJECT = "patient_id bigint, area string, kind string"
CANDIDATE = "provider_id bigint, area string, kind string, name string"


def expected(subjects, candidates, seed):
    """Rank each cell by hash and index into it."""
    def digest(key, n=32):
        return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:n]

    out = {}
    for key, area, kind in subjects:
        cell = [c for c in candidates if c[1] == area and c[2] == kind and kind is not None]
        tier = "fine" if cell else "coarse"
        cell = cell or [c for c in candidates if c[1] == area]
        if not cell:
            out[key] = (None, None)
            continue
        ranked = sorted(cell, key=lambda c: (digest(c[0]), c[0]))
        out[key] = (ranked[int(digest(key, 15), 16) % len(ranked)][0], tier)
    return out


@pytest.mark.parametrize("digits", [1, 3])
def test_matches_equal_brute_force(spark, digits):
    candidates = [(i, "dense", "x" if i % 3 else "y", f"n{i}") for i in range(300)]
    candidates += [(900, "single", "x", "n900"), (901, "odd", None, "n901")]
    subjects = [(i, "dense", ("x", "y", "z")[i % 3]) for i in range(200)]
    subjects += [(500, "single", "x"), (501, "single", "y"), (502, "nowhere", "x"), (503, "dense", None), (504, "odd", "x"), (505, None, "x")]
    got = match_with_fallback(
        spark.createDataFrame(subjects, SUBJECT), spark.createDataFrame(candidates, CANDIDATE),
        "area", "kind", "patient_id", "provider_id", 5, carry=("name",), digits=digits,
    ).collect()
    assert len(got) == len(subjects)
    assert {r["patient_id"]: (r["provider_id"], r["match_tier"]) for r in got} == expected(subjects, candidates, 5)
    assert all(r["name"] == (f"n{r['provider_id']}" if r["provider_id"] is not None else None) for r in got)


def test_every_candidate_of_a_dense_cell_is_used(spark):
    candidates = spark.range(20).selectExpr("id AS provider_id", "'a' AS area", "'x' AS kind")
    subjects = spark.range(4000).selectExpr("id AS patient_id", "'a' AS area", "'x' AS kind")
    got = match_with_fallback(subjects, candidates, "area", "kind", "patient_id", "provider_id", 1)
    counts = [r["count"] for r in got.groupBy("provider_id").count().collect()]
    assert len(counts) == 20 and min(counts) > 120 and max(counts) < 290


def test_candidates_are_read_twice_and_planning_runs_no_job(spark):
    group = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    plan = roles.assignments(spark, "/root/testdata/sf0.001")
    started = group.getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not started
    plan.collect()
    final = plan._jdf.queryExecution().executedPlan().toString()
    reads = [line for line in final.split("Initial Plan")[0].splitlines() if "Scan parquet" in line and "s_suppkey" in line]
    assert len(reads) == 2 and "collect_list" not in final and "CartesianProduct" not in final and "NestedLoop" not in final
