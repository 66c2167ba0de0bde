from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sojourn.functions.expr import days_between
from sojourn.operators.eligibility import build_eligibility, derive_mhspc, flag_stage
from sojourn.params import Params
from sojourn.plans import catalog, timeline

PARAMS = Params()
ELIGIBLE = dt.date(2021, 1, 1)
ROW = (
    "patient_id string, eligible_for_arpi boolean, eligibility_date date, treatment_start_date date, "
    "covered_until_date date, discontinuation_flag boolean, discontinuation_date date, switch_date date, "
    "progression_date date, censor_date date, max_refill_gap_days bigint"
)


def row(spark, eligible=True, start=0, covered=500, stop=None, censor=1000, gap=0):
    def on(n):
        return None if n is None else ELIGIBLE + dt.timedelta(days=n)

    stopped = None if start is None else stop is not None
    data = [("p", eligible, ELIGIBLE, on(start), on(covered), stopped, on(stop), None, None, on(censor), gap)]
    df = spark.createDataFrame(data, ROW)
    df = df.withColumns({**timeline.initiation_columns(PARAMS), **timeline.elapsed_columns()})
    return df.withColumns(timeline.persistence_columns(PARAMS)).first()


@pytest.mark.parametrize("days", [90, 180, 365])
def test_landmark_bounds(spark, days):
    name = {90: "persistent_3m", 180: "persistent_6m", 365: "persistent_12m"}[days]
    assert row(spark, covered=days)[name]
    assert not row(spark, covered=days - 1)[name]
    assert not row(spark, covered=500, stop=days)[name]
    assert row(spark, covered=500, stop=days + 1)[name]
    assert row(spark, censor=days)[name]
    assert not row(spark, censor=days - 1)[name]


def test_gap_sensitivity(spark):
    got = row(spark, gap=31)
    assert not got["persistent_12m_gap_30d"] and got["persistent_12m_gap_60d"] and got["persistent_12m_gap_90d"]
    unknown = row(spark, gap=None)
    assert unknown["persistent_12m"] and not unknown["persistent_12m_gap_90d"]


def test_initiation_windows_nest_and_complement_the_gap(spark):
    for start, flags in ((0, (1, 1, 1)), (30, (1, 1, 1)), (31, (0, 1, 1)), (60, (0, 1, 1)), (90, (0, 0, 1)), (91, (0, 0, 0))):
        got = row(spark, start=start)
        assert tuple(int(got[f"initiated_within_{n}d"]) for n in (30, 60, 90)) == flags
        assert got["eligible_not_initiated_90d"] == (not got["initiated_within_90d"])
    ineligible = row(spark, eligible=False)
    assert not ineligible["initiated_within_90d"] and not ineligible["eligible_not_initiated_90d"]
    assert ineligible["treatment_initiated"]


def test_untreated_patient_has_false_flags_and_null_days(spark):
    got = row(spark, start=None, covered=None, gap=None)
    assert not got["treatment_initiated"] and got["days_to_initiation"] is None
    assert got["eligible_not_initiated_90d"] and not got["persistent_3m"] and not got["persistent_12m_gap_90d"]


def test_follow_up_is_never_negative(spark):
    assert row(spark, censor=-5)["follow_up_days"] == 0


def diagnosis(spark, stage="metastatic", sensitive=True, resistant=False, gleason=8):
    data = [("p", stage, ELIGIBLE, ELIGIBLE + dt.timedelta(days=9), True, sensitive, resistant, gleason)]
    schema = (
        "patient_id string, prostate_stage string, diagnosis_date date, metastatic_date date, "
        "prostate_cancer_flag boolean, hormone_sensitive_flag boolean, castration_resistant_flag boolean, "
        "gleason_score bigint"
    )
    return flag_stage(spark.createDataFrame(data, schema))


@pytest.mark.parametrize(("score", "group"), [(6, 1), (8, 3), (10, 5), (12, 5), (2, 1), (None, None)])
def test_grade_group_is_clamped_and_keeps_null(spark, score, group):
    assert diagnosis(spark, gleason=score).first()["isup_grade_group"] == group


def test_confirmation_follows_the_stage(spark):
    metastatic = diagnosis(spark).first()
    assert metastatic["hormone_sensitive_confirmation_date"] == ELIGIBLE + dt.timedelta(days=9)
    local = diagnosis(spark, "localized").first()
    assert local["hormone_sensitive_confirmation_date"] == ELIGIBLE and local["metastatic_date"] is None
    assert local["localized_flag"] and not local["metastatic_flag"]


@pytest.mark.parametrize(
    ("given", "expected"),
    [({}, True), ({"stage": "localized"}, False), ({"sensitive": False}, False), ({"sensitive": None}, False), ({"resistant": True}, False)],
)
def test_disease_state_rule(spark, given, expected):
    assert derive_mhspc(diagnosis(spark, **given)).first()["mhspc_flag"] is expected


@pytest.mark.parametrize(
    ("age", "contra", "end", "expected"),
    [
        (18, False, 99, True), (17, False, 99, False), (None, False, 99, False),
        (60, True, 99, False), (60, None, 99, True), (60, False, 98, False),
    ],
)
def test_eligibility_rule(spark, age, contra, end, expected):
    params = Params(observation_end_date=ELIGIBLE + dt.timedelta(days=end))
    patient = spark.createDataFrame([("p", age, contra)], "patient_id string, age_at_index int, contraindication_flag boolean")
    got = build_eligibility(patient, diagnosis(spark), params).first()
    assert got["eligibility_date"] == ELIGIBLE + dt.timedelta(days=9)
    assert got["eligible_for_arpi"] is expected


@pytest.fixture(scope="module")
def bound(spark):
    return catalog.journey(spark, "/root/testdata/sf0.001").cache()


def test_journey_has_the_published_columns_and_one_row_per_patient(bound):
    assert tuple(bound.columns) == timeline.JOURNEY_COLUMNS and len(bound.columns) == 65
    assert bound.count() == bound.select("patient_id").distinct().count() == 150


def test_journey_implications(bound):
    broken = {
        "state": "mhspc_flag AND NOT (metastatic_flag AND hormone_sensitive_flag AND NOT castration_resistant_flag)",
        "eligible": "eligible_for_arpi AND NOT mhspc_flag",
        "death": "death_flag AND death_date IS NULL",
        "lost": "lost_to_follow_up_flag AND last_observed_date IS NULL",
        "apart": "death_flag AND lost_to_follow_up_flag",
        "switch": "switch_flag AND (switch_date IS NULL OR switched_to_drug = initial_treatment)",
        "nest": "(initiated_within_30d AND NOT initiated_within_60d) OR (initiated_within_60d AND NOT initiated_within_90d)",
        "persist": "(persistent_12m AND NOT persistent_6m) OR (persistent_6m AND NOT persistent_3m)",
        "gap": "eligible_not_initiated_90d <> (eligible_for_arpi AND NOT initiated_within_90d)",
        "reason": "discontinuation_reason IN ('death', 'lost_to_follow_up')",
        "days": "days_to_initiation < 0 OR follow_up_days < 0",
    }
    counts = bound.agg(*[F.count_if(F.expr(rule)).alias(name) for name, rule in broken.items()]).first().asDict()
    assert counts == dict.fromkeys(broken, 0)


def test_journey_is_the_same_for_shuffled_input_and_other_partition_counts(spark, bound):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        again = catalog.journey(spark, "/root/testdata/sf0.001")
        assert sorted(map(str, again.collect())) == sorted(map(str, bound.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_features_hide_a_delay_not_yet_known(bound):
    features = timeline.model_ready_features(bound)
    assert tuple(features.columns) == timeline.FEATURE_COLUMNS
    assert features.filter("referral_delay_days IS NOT NULL").count() > 0
    cut = timeline.model_ready_features(bound, as_of="eligibility_date")
    assert cut.filter("referral_delay_days IS NOT NULL").count() == 0


def test_elapsed_days_are_bigint(spark):
    assert spark.range(1).select(days_between(F.current_date(), F.current_date()).alias("d")).schema["d"].dataType.typeName() == "long"
