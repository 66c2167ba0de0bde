from __future__ import annotations

import dataclasses

import pytest

from sojourn.params import Params
from sojourn.sources import intake

HEADER = "Id,BIRTHDATE,GENDER,ZIP,DEATHDATE"
GOOD = ["a,1955-06-01,M,02186,", "b,2010-01-01,M,10001,", 'c,1960-02-03,male,"0,2186",2020-01-01', "d,1950-01-01,F,1,", "e,,M,3,"]
BAD = {
    "f,1955-06-01": "malformed record",
    "g,1955-06-01,M,02186,,extra": "malformed record",
    ",1955-06-01,M,02186,": "no key",
    " ,1955-06-01,M,02186,": "no key",
    "h,soon,M,02186,": "BIRTHDATE is not a date",
    "i,1955-06-01,M,02186,never": "DEATHDATE is not a date",
    "j,soon,M,02186,never": "BIRTHDATE is not a date",
}
PARAMS = Params()


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "PATIENTS.csv").write_text("\n".join([HEADER, *GOOD[:3], *BAD, *GOOD[3:]]) + "\n")
    return str(tmp_path)


def test_records_are_parted_by_the_contract(spark, folder):
    found = intake.patient_intake(spark, folder)
    assert found.accepted.columns == HEADER.split(",")
    rows = {r["Id"]: r for r in found.accepted.collect()}
    assert sorted(rows) == ["a", "b", "c", "d", "e"] and rows["c"]["ZIP"] == "0,2186" and rows["a"]["DEATHDATE"] is None
    # a count alone must not lose sight of malformed records
    assert found.accepted.count() == 5 and found.quarantined.count() == len(BAD)
    got = {r["record"].strip(): (r["table_name"], r["reason"]) for r in found.quarantined.collect()}
    assert got == {line.strip(): ("patients", reason) for line, reason in BAD.items()}


@pytest.mark.parametrize("size", [1, 2, 5])
def test_a_folder_becomes_a_cohort_of_the_wanted_size(spark, folder, size):
    cohort = intake.cohort_from_csv(spark, folder, dataclasses.replace(PARAMS, target_cohort_size=size)).collect()
    assert len(cohort) == size and len({r["patient_id"] for r in cohort}) == size
    assert {r["synthea_patient_id"] for r in cohort} <= {"a", "c"} and {r["sex"] for r in cohort} == {"male"}
    assert not any(r["population_representative_flag"] for r in cohort)
    again = intake.cohort_from_csv(spark, folder, dataclasses.replace(PARAMS, target_cohort_size=size)).collect()
    assert sorted(again) == sorted(cohort)


def test_nothing_to_draw_from(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        intake.cohort_from_csv(spark, str(tmp_path / "absent"), PARAMS)
    (tmp_path / "patients.csv").write_text(f"{HEADER}\nb,2010-01-01,M,1,\n")
    with pytest.raises(ValueError, match="eligible"):
        intake.cohort_from_csv(spark, str(tmp_path), PARAMS)


def test_header_case_and_absent_columns(spark, tmp_path):
    (tmp_path / "patients.csv").write_text("patient_id,birthdate,gender\n7,1950-02-03,m\n8,bad,m\n")
    found = intake.patient_intake(spark, str(tmp_path))
    assert [r["patient_id"] for r in found.accepted.collect()] == ["7"]
    assert [(r["record_key"], r["reason"]) for r in found.quarantined.collect()] == [("8", "BIRTHDATE is not a date")]
    cohort = intake.cohort_from_csv(spark, str(tmp_path), dataclasses.replace(PARAMS, target_cohort_size=1)).first()
    assert cohort["synthea_patient_id"] == "7" and cohort["postal_code_prefix"] is None


def test_a_quarantined_record_keeps_its_missing_fields(spark, tmp_path):
    """A field without a value stays an empty field, malformed record or not; dropping it would shift all that follow."""
    lines = ["k,1955-06-01,,02,186,", "l,soon,,02186,"]
    (tmp_path / "patients.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    found = intake.patient_intake(spark, str(tmp_path))
    assert sorted(r["record"] for r in found.quarantined.collect()) == lines and found.accepted.count() == 0
