from __future__ import annotations

import dataclasses
import datetime as dt
import re

import pytest

from sojourn.params import Params
from sojourn.plans import publish, quality
from sojourn.sources import files, roles

D = dt.date
SF_DIR = "/root/testdata/sf0.001"
SCHEMAS = {
    "patient": "patient_id string, sex string, birth_date date",
    "diagnosis": "patient_id string, diagnosis_date date, metastatic_date date",
    "provider": "provider_id string",
    "encounter": "patient_id string, provider_id string",
    "treatment": "patient_id string, prescribing_provider_id string, treatment_start_date date, treatment_end_date date, "
    "refill_date date, covered_until_date date, discontinuation_reason string, switch_date date",
    "outcome": "patient_id string, death_flag boolean, death_date date, lost_to_follow_up_flag boolean, "
    "last_observed_date date, censor_date date",
    "patient_journey": "patient_id string, age_at_index int, prostate_stage string, initial_care_setting string, "
    "initial_provider_specialty string, initial_treatment string, final_outcome_status string, mhspc_flag boolean, "
    "metastatic_flag boolean, hormone_sensitive_flag boolean, castration_resistant_flag boolean, "
    "eligible_for_arpi boolean, eligibility_date date, treatment_start_date date, treatment_initiated boolean, "
    "referral_delay_days bigint, days_to_initiation bigint, days_to_discontinuation bigint, days_to_switch bigint, "
    "days_to_progression bigint, follow_up_days bigint, persistent_3m boolean, persistent_6m boolean, "
    "persistent_12m boolean, switch_flag boolean, switch_date date, restart_flag boolean, restart_date date, "
    "discontinuation_date date, progression_date date, first_hospitalisation_date date, censor_date date",
}


@pytest.fixture(scope="module", autouse=True)
def small_plans(spark):
    """A handful of rows: no need for re-planning or more than one partition."""
    names = ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    before = {name: spark.conf.get(name) for name in names}
    spark.conf.set(names[0], "false")
    spark.conf.set(names[1], "1")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def clean():
    """Two patients that pass every rule."""
    out = {name: [] for name in SCHEMAS}
    out["provider"] = [{"provider_id": "r1"}]
    for key in ("a", "b"):
        out["patient"].append({"patient_id": key, "sex": "male", "birth_date": D(1950, 1, 1)})
        out["diagnosis"].append(
            {"patient_id": key, "diagnosis_date": D(2021, 1, 1), "metastatic_date": D(2021, 1, 1)}
        )
        out["encounter"].append({"patient_id": key, "provider_id": "r1"})
        out["treatment"].append(
            {
                "patient_id": key, "prescribing_provider_id": "r1", "treatment_start_date": D(2021, 2, 1),
                "treatment_end_date": D(2022, 6, 1), "refill_date": D(2021, 2, 1),
                "covered_until_date": D(2022, 6, 1), "discontinuation_reason": "other", "switch_date": D(2021, 6, 1),
            }
        )
        out["outcome"].append(
            {
                "patient_id": key, "death_flag": True, "death_date": D(2023, 1, 1), "lost_to_follow_up_flag": False,
                "last_observed_date": D(2023, 6, 1), "censor_date": D(2023, 1, 1),
            }
        )
        out["patient_journey"].append(
            {
                "patient_id": key, "age_at_index": 70, "prostate_stage": "metastatic",
                "initial_care_setting": "mixed_pathway", "initial_provider_specialty": "urology",
                "initial_treatment": "ADT", "final_outcome_status": "deceased", "mhspc_flag": True,
                "metastatic_flag": True, "hormone_sensitive_flag": True, "castration_resistant_flag": False,
                "eligible_for_arpi": True, "eligibility_date": D(2021, 1, 1), "treatment_start_date": D(2021, 2, 1),
                "treatment_initiated": True, "referral_delay_days": 0, "days_to_initiation": 31,
                "days_to_discontinuation": None, "days_to_switch": 120, "days_to_progression": None,
                "follow_up_days": 730, "persistent_3m": True, "persistent_6m": True, "persistent_12m": True,
                "switch_flag": True, "switch_date": D(2021, 6, 1), "restart_flag": None, "restart_date": None,
                "discontinuation_date": None, "progression_date": None, "first_hospitalisation_date": None,
                "censor_date": D(2023, 1, 1),
            }
        )
    return out


def results(spark, rows, params=None, only=None):
    frames = {}
    for name, schema in SCHEMAS.items():
        names = [part.split()[0] for part in schema.split(", ")]
        frames[name] = spark.createDataFrame([tuple(r[n] for n in names) for r in rows[name]], schema)
    found = quality.validate_tables(frames, params, only)
    assert found.columns == ["rule", "severity", "status", "failure_count", "detail"]
    return found


def counts(spark, rows, params=None, only=None):
    return {r["rule"]: r["failure_count"] for r in results(spark, rows, params, only).collect()}


def test_clean_tables_pass_all_34_rules(spark):
    got = counts(spark, clean())
    assert set(got) == set(quality.RULES) and len(got) == 34
    assert set(got.values()) == {0}


def change(table, **values):
    def apply(rows):
        rows[table][0].update(values)

    return apply


def drop(table):
    def apply(rows):
        rows[table].pop(0)

    return apply


BROKEN = {
    "patient_unique": change("patient", patient_id="b"),
    "male_only": change("patient", sex="female"),
    "birth_before_diagnosis": change("patient", birth_date=D(2021, 1, 1)),
    "diagnosis_before_metastatic": change("diagnosis", metastatic_date=D(2020, 12, 31)),
    "eligibility_before_treatment": change("patient_journey", eligibility_date=D(2021, 2, 2)),
    "treatment_dates": change("treatment", treatment_end_date=D(2021, 2, 1)),
    "death_after_birth": change("patient", birth_date=D(2023, 1, 1)),
    "death_censor_alignment": change("outcome", censor_date=D(2022, 12, 31)),
    "mhspc_implies_metastatic": change("patient_journey", metastatic_flag=False),
    "mhspc_implies_hormone_sensitive": change("patient_journey", hormone_sensitive_flag=False),
    "mhspc_excludes_cr": change("patient_journey", castration_resistant_flag=True),
    "eligibility_implies_mhspc": change("patient_journey", mhspc_flag=False),
    "nonnegative_referral_delay_days": change("patient_journey", referral_delay_days=-1),
    "nonnegative_days_to_initiation": change("patient_journey", days_to_initiation=-1),
    "nonnegative_days_to_discontinuation": change("patient_journey", days_to_discontinuation=-1),
    "nonnegative_days_to_switch": change("patient_journey", days_to_switch=-1),
    "nonnegative_days_to_progression": change("patient_journey", days_to_progression=-1),
    "persistence_requires_followup": change("patient_journey", follow_up_days=364),
    "switch_has_date": change("patient_journey", switch_date=None),
    "restart_has_date": change("patient_journey", restart_flag=True),
    "death_has_date": change("outcome", death_date=None),
    "ltfu_has_last_observed": change("outcome", lost_to_follow_up_flag=True, last_observed_date=None),
    "no_switch_after_death": change("treatment", switch_date=D(2023, 1, 2)),
    "no_treatment_after_death": change(
        "treatment", treatment_start_date=D(2023, 1, 2), treatment_end_date=D(2023, 2, 1),
        refill_date=D(2023, 1, 2), covered_until_date=D(2023, 2, 1),
    ),
    "death_not_nonadherence": change("treatment", discontinuation_reason="death"),
    "ltfu_not_discontinuation": change("treatment", discontinuation_reason="lost_to_follow_up"),
    "persistence_requires_initiation": change("patient_journey", treatment_initiated=False),
    "refill_after_start": change("treatment", refill_date=D(2021, 1, 31)),
    "coverage_after_refill": change("treatment", refill_date=D(2022, 6, 2)),
    "encounter_provider_fk": change("encounter", provider_id="r9"),
    "treatment_provider_fk": change("treatment", prescribing_provider_id=None),
    "patient_foreign_keys": change("encounter", patient_id=None),
    "diagnosis_patient_coverage": drop("diagnosis"),
    "outcome_patient_coverage": drop("outcome"),
}


@pytest.mark.parametrize("rule", list(quality.RULES))
def test_one_bad_row_fails_its_rule(spark, rule):
    rows = clean()
    BROKEN[rule](rows)
    assert counts(spark, rows, only={rule}) == {rule: 1}


def test_a_bad_row_fails_no_other_rule(spark):
    rows = clean()
    for rule in ("male_only", "treatment_dates", "mhspc_implies_metastatic", "encounter_provider_fk"):
        BROKEN[rule](rows)
    failed = {name: n for name, n in counts(spark, rows).items() if n}
    assert failed == {
        "male_only": 1, "treatment_dates": 1, "mhspc_implies_metastatic": 1, "encounter_provider_fk": 1,
    }


def test_unknown_rule_is_refused(spark):
    with pytest.raises(ValueError, match="nothing_like_it"):
        counts(spark, clean(), only={"nothing_like_it"})


def test_repeated_patients_weigh_joined_rules_like_the_join_would(spark):
    rows = clean()
    rows["patient"] += [dict(rows["patient"][0], birth_date=D(2022, 1, 1)) for _ in range(3)]
    rows["diagnosis"] += [
        dict(rows["diagnosis"][0], metastatic_date=D(2020, 1, 1)),
        dict(rows["diagnosis"][0], diagnosis_date=D(2022, 5, 1), metastatic_date=None),
    ]
    p = [r["birth_date"] for r in rows["patient"] if r["patient_id"] == "a"]
    d = [(r["diagnosis_date"], r["metastatic_date"]) for r in rows["diagnosis"] if r["patient_id"] == "a"]
    got = counts(spark, rows)
    assert got["birth_before_diagnosis"] == sum(b >= x for b in p for x, _ in d) == 6
    assert got["diagnosis_before_metastatic"] == sum(m is not None and x > m for _ in p for x, m in d) == 4
    assert got["patient_unique"] == 3


def test_null_keys_count_as_orphans_and_gaps(spark):
    rows = clean()
    rows["patient"].append({"patient_id": None, "sex": "male", "birth_date": D(1950, 1, 1)})
    rows["diagnosis"].append({"patient_id": None, "diagnosis_date": D(2021, 1, 1), "metastatic_date": None})
    got = counts(spark, rows)
    assert got["patient_foreign_keys"] == 1
    assert got["diagnosis_patient_coverage"] == 1 and got["outcome_patient_coverage"] == 1


def test_warnings_beyond_the_published_rules(spark):
    rows = clean()
    rows["patient_journey"][0].update(
        age_at_index=91, prostate_stage="odd", progression_date=D(2023, 1, 2), initial_care_setting=None
    )
    got = counts(spark, rows, Params(missingness_warning_share=0.4))
    assert got["age_in_configured_range"] == 1 and got["event_after_censor"] == 1
    assert got["expected_categories"] == 1
    empty = {"days_to_discontinuation", "days_to_progression", "restart_flag", "restart_date", "discontinuation_date",
             "first_hospitalisation_date", "progression_date", "initial_care_setting"}
    assert got["missingness"] == len(empty)
    severities = {r["severity"] for r in results(spark, rows, Params()).collect() if r["rule"] in quality.EXTRA_RULES}
    assert severities == {"warning"}


def test_gate_and_raise_name_critical_rules_only(spark):
    rows = clean()
    rows["patient_journey"][0]["follow_up_days"] = 10
    warned = results(spark, rows)
    quality.raise_on_critical(warned)
    row = quality.gate(warned).first()
    assert (row["warning_rules_failed"], row["critical_failures"], row["verdict"]) == (1, 0, "publish")
    rows["patient"][0]["sex"] = "female"
    with pytest.raises(quality.CriticalQualityFailure, match="male_only"):
        quality.raise_on_critical(results(spark, rows))
    assert quality.gate(results(spark, rows)).first()["verdict"] == "hold"


def _read_schemas(df):
    """Columns that the scans of a plan read, as name:type lists."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    return re.findall(r"ReadSchema: struct<([^>]*)>", df._jdf.queryExecution().executedPlan().toString())


def row_rules():
    return {rule for conditions in quality.ROW_RULES.values() for rule in conditions()} | set(quality.EXTRA_RULES)


def test_row_rules_are_measured_while_tables_are_written(spark):
    observed, measured = roles.observed(spark, SF_DIR), {}
    tables = publish.build_tables(observed, roles.BOUND, files.new_stage(spark), measured=measured)
    assert set(measured) == row_rules()
    scanned = {r["rule"]: r["failure_count"] for r in quality.validate_tables(tables, roles.BOUND).collect()}
    assert measured == {rule: scanned[rule] for rule in measured} and sum(measured.values()) > 0
    results = quality.validate_tables(tables, roles.BOUND, measured=measured)
    assert {r["rule"]: r["failure_count"] for r in results.collect()} == scanned
    # no column is read that only row rules ask for
    read = {field.split(":")[0] for part in _read_schemas(results) for field in part.split(",")}
    assert "patient_id" in read and not read & {"sex", "discontinuation_reason", "persistent_12m", "last_observed_date"}


def test_nothing_to_measure_is_measured_as_nothing(spark):
    observed = roles.observed(spark, SF_DIR)
    empty = dataclasses.replace(observed, **{f.name: getattr(observed, f.name).limit(0) for f in dataclasses.fields(observed) if f.name not in ("source_visit", "target_visit")})
    measured = {}
    tables = publish.build_tables(empty, roles.BOUND, files.new_stage(spark), measured=measured)
    assert set(measured) == row_rules() and not any(measured.values())
    assert not any(r["failure_count"] for r in quality.validate_tables(tables, roles.BOUND, measured=measured).collect())
