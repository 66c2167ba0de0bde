from __future__ import annotations

import datetime as dt

from sojourn.operators import cohort, sampling
from sojourn.params import Params
from sojourn.sources.files import RAW_PATIENT_SCHEMA, load_csv_directory

PARAMS = Params()


def two_men(spark):
    rows = [("a", "1955-06-01", "M"), ("b", "2010-01-01", "M")]
    return spark.createDataFrame(rows, "Id string, BIRTHDATE string, GENDER string")


def test_young_row_drops_out_and_the_rest_is_oversampled(spark):
    selected = cohort.select_cohort(two_men(spark), PARAMS)
    drawn = sampling.sample_to_size(selected, "Id", 5, 42)
    assert [r["Id"] for r in drawn.collect()] == ["a"] * 5


def test_oversampled_patients_stay_unique(spark):
    drawn = sampling.sample_to_size(cohort.select_cohort(two_men(spark), PARAMS), "Id", 5, 42)
    patients = cohort.normalize_patients(drawn, PARAMS, draw="draw")
    rows = cohort.publish_keys(patients).collect()
    assert sorted(r["patient_id"] for r in rows) == [f"PJ-{i:08d}" for i in range(5)]
    assert {r["synthea_patient_id"] for r in rows} == {"a"}
    assert {r["sex"] for r in rows} == {"male"}
    assert not any(r["population_representative_flag"] for r in rows)
    assert all(r["synthetic_oversampling_flag"] and r["sampling_weight"] == 1.0 for r in rows)


def test_selection_bounds_are_inclusive_and_null_birth_drops_out(spark):
    index = PARAMS.index_date
    ages = {"low": 50 * 365, "under": 50 * 365 - 1, "high": 90 * 365 + 364, "over": 91 * 365}
    rows = [(k, str(index - dt.timedelta(days=v)), "male") for k, v in ages.items()]
    rows += [("bad", "n/a", "M"), ("woman", str(index - dt.timedelta(days=60 * 365)), "F")]
    raw = spark.createDataFrame(rows, "id string, birthdate string, gender string")
    kept = {r["id"] for r in cohort.select_cohort(raw, PARAMS).collect()}
    assert kept == {"low", "high"}


def test_lower_case_headers_absent_columns_and_leading_zero(spark):
    raw = spark.createDataFrame(
        [("7", "1950-02-03", "02186", "WHITE")], "id string, birthdate string, zip string, race string"
    )
    row = cohort.normalize_patients(raw, PARAMS).first()
    assert row["postal_code_prefix"] == "021" and row["race"] == "white"
    assert row["ethnicity"] == "nonhispanic" and row["region"] is None
    assert (row["birth_date"], row["birth_year"]) == (dt.date(1950, 2, 3), 1950)
    assert len(row) == 20


def test_csv_directory_keeps_zip_text_and_lower_case_stems(spark, tmp_path):
    header = ",".join(f.name for f in RAW_PATIENT_SCHEMA)
    values = {"Id": "p1", "BIRTHDATE": "1950-01-01", "GENDER": "M", "ZIP": "02186"}
    line = ",".join(values.get(f.name, "") for f in RAW_PATIENT_SCHEMA)
    (tmp_path / "Patients.csv").write_text(f"{header}\n{line}\n")
    (tmp_path / "payers.csv").write_text("Id,NAME\n1,x\n")
    (tmp_path / "notes.txt").write_text("skip")
    tables = load_csv_directory(spark, str(tmp_path), {"patients": RAW_PATIENT_SCHEMA})
    assert list(tables) == ["patients", "payers"]
    assert tables["patients"].first()["ZIP"] == "02186"
    assert load_csv_directory(spark, str(tmp_path / "absent")) == {}


def test_death_date_comes_from_the_outcome(spark):
    patient = cohort.normalize_patients(two_men(spark), PARAMS)
    outcome = spark.createDataFrame([("a", dt.date(2024, 1, 1))], "patient_id string, death_date date")
    got = {r["patient_id"]: r["date_of_death"] for r in cohort.attach_death_date(patient, outcome).collect()}
    assert got == {"a": dt.date(2024, 1, 1), "b": None}
