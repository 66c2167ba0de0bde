from __future__ import annotations

import datetime as dt

import pytest

from sojourn.operators.eligibility import build_eligibility
from sojourn.operators.episodes import fill_days, treated_patients, treatment_history
from sojourn.operators.outcomes import derive_outcome, with_clinical_dates
from sojourn.params import Params
from sojourn.plans import catalog, publish
from sojourn.sources import roles

SF_DIR = "/root/testdata/sf0.001"
PARAMS = Params(observation_end_date=dt.date(2022, 12, 31), loss_to_follow_up_days=180)
END = PARAMS.observation_end_date
INDEX = dt.date(2021, 1, 1)
ACTIVE = END - dt.timedelta(days=10)
SILENT = END - dt.timedelta(days=181)

SPINE = (
    "patient_id string, mhspc_flag boolean, progression_date date, castration_resistant_date date, "
    "first_hospitalisation_date date, adverse_event_date date, death_date date, adverse_event_type string"
)
TREATED = (
    "patient_id string, last_activity_date date, restart_flag boolean, switch_flag boolean, "
    "discontinuation_flag boolean"
)


def outcome(spark, progression=None, death=None, last=None, flags=(False, False, False), resistant=None, mhspc=True):
    spine = spark.createDataFrame([("p", mhspc, progression, resistant, None, None, death, "fatigue")], SPINE)
    treated = spark.createDataFrame([("p", last, *flags)] if last else [], TREATED)
    return derive_outcome(spine, treated, PARAMS).first()


PROGRESSED = dt.date(2022, 3, 1)
DEAD = dt.date(2022, 6, 1)


@pytest.mark.parametrize(
    ("given", "status"),
    [
        ({"progression": PROGRESSED, "death": DEAD, "last": SILENT, "flags": (True, True, True)}, "deceased"),
        ({"progression": PROGRESSED, "last": SILENT, "flags": (True, True, True)}, "lost_to_follow_up"),
        ({"progression": PROGRESSED, "last": ACTIVE, "flags": (True, True, True)}, "progressed"),
        ({"last": ACTIVE, "flags": (True, True, True)}, "restarted"),
        ({"last": ACTIVE, "flags": (False, True, True)}, "switched"),
        ({"last": ACTIVE, "flags": (False, False, True)}, "discontinued"),
        ({"last": ACTIVE}, "active_treatment"),
        ({}, "censored"),
    ],
)
def test_most_final_state_wins(spark, given, status):
    assert outcome(spark, **given)["outcome_status"] == status


def test_censoring_is_the_earliest_of_end_death_and_loss(spark):
    assert outcome(spark, last=ACTIVE)["censor_date"] == END
    assert outcome(spark, death=DEAD, last=ACTIVE)["censor_date"] == DEAD
    lost = outcome(spark, last=SILENT)
    assert lost["lost_to_follow_up_flag"] and lost["censor_date"] == lost["last_observed_date"] == SILENT
    edge = outcome(spark, last=END - dt.timedelta(days=180))
    assert not edge["lost_to_follow_up_flag"]


def test_never_treated_is_not_lost(spark):
    row = outcome(spark)
    assert not row["lost_to_follow_up_flag"] and row["last_observed_date"] == END


def test_death_rules_out_loss(spark):
    assert not outcome(spark, death=DEAD, last=SILENT)["lost_to_follow_up_flag"]


def test_resistance_needs_disease_state_and_progression_first(spark):
    later, earlier = dt.date(2022, 4, 1), dt.date(2022, 2, 1)
    assert outcome(spark, progression=PROGRESSED, resistant=later)["castration_resistant_transition"]
    for given in (
        {"progression": PROGRESSED, "resistant": earlier},
        {"resistant": later},
        {"progression": PROGRESSED, "resistant": later, "mhspc": False},
    ):
        row = outcome(spark, **given)
        assert not row["castration_resistant_transition"] and row["castration_resistant_date"] is None


def test_detail_shows_only_with_an_adverse_event(spark):
    assert outcome(spark)["adverse_event_type"] is None


def test_events_after_observation_are_dropped_and_before_index_ignored(spark):
    index = spark.createDataFrame([("p", INDEX)], "patient_id string, eligibility_date date")
    rows = [
        ("p", "death", END + dt.timedelta(days=1), None),
        ("p", "progression", INDEX - dt.timedelta(days=1), None),
        ("p", "progression", INDEX, None),
        ("p", "adverse_event", END, "fatigue"),
    ]
    events = spark.createDataFrame(
        rows, "patient_id string, event_type string, event_date date, event_detail string"
    )
    row = with_clinical_dates(index, events, PARAMS).first()
    assert row["death_date"] is None and row["progression_date"] == INDEX
    assert (row["adverse_event_date"], row["adverse_event_type"]) == (END, "fatigue")


def scans(df, column):
    """Scans of the final plan that read a column; the plan's exchanges are reused where they are alike."""
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return [line for line in final.splitlines() if "Scan parquet" in line and column in line]


def test_outcome_reads_line_items_once_for_fills_and_once_for_events(spark):
    assert len(scans(catalog.outcome_status(spark, SF_DIR), "l_shipdate")) == 2


def test_fills_after_censoring_share_the_fold(spark):
    checked = catalog.after_terminal(spark, SF_DIR)
    # the fold itself was staged by one scan
    assert len(scans(checked, "l_shipdate")) == 1


def test_outcome_equals_the_one_from_tables(spark):
    observed = roles.observed(spark, SF_DIR)
    judged = build_eligibility(observed.patient, observed.diagnosis, roles.BOUND)
    spine = with_clinical_dates(judged, observed.clinical, roles.BOUND)
    treated = treated_patients(treatment_history(observed.fills, spine, roles.BOUND))
    apart, one = derive_outcome(spine, treated, roles.BOUND), publish.observed_outcome(observed, roles.BOUND)
    days = publish.observed_outcome(observed, roles.BOUND, fill_days(observed.fills, roles.BOUND))
    assert one.exceptAll(apart).count() == 0 and apart.exceptAll(one).count() == 0 and one.exceptAll(days).count() == 0
