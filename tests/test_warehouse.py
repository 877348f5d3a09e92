import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from wardstar import schemas
from wardstar.operators import clean, dates, dedup, documents, extract, flatten, quality
from wardstar.plans import warehouse
from wardstar.sources import sinks, tables

PATIENTS = """Id,BIRTHDATE,FIRST,LAST,GENDER,CITY,STATE,ZIP,MIDDLE
p1,1960-05-01,Abe604,Smith12,M, Austin ,Texas,78701.0,x
p2,,Zoe,Lee,,,texas,NULL,
p3,2030-01-01,Al,Po,F,Waco,TX,123,
p1,1961-05-01,Abe,Again,M,Laredo,TX,,
"""
FILES = {
    "patients": PATIENTS,
    "payers": "Id,NAME\nx1,Aetna\nx2,aetna \n",
    "organizations": "Id,NAME,CITY,STATE\no1,General,Houston,TX\no2,General,houston ,Texas\no3,GENERAL,HOUSTON,TX\no4,Other,,TX\n",
    "providers": "Id,NAME,SPECIALITY\nd1,Abe604 Smith12,Cardiology\nd2,Abe7 Smith,cardiology\nd3,Dr. XYZ,\nd4,,Surgery\n",
    "encounters": "Id,START,PATIENT,PROVIDER,ORGANIZATION,PAYER,ENCOUNTERCLASS,DESCRIPTION,TOTAL_CLAIM_COST\n"
    "e1,2019-01-01T23:30:00Z,p1,d1,o3,x2,wellness,Check,100.005\n"
    "e2,2019-01-01T01:00:00Z,p2,d2,o2,nope,urgent,\"Said \"\"ouch\"\"\",abc\n"
    "e3,bad date,ghost,d1,o1,x1,urgent,Dropped,1\n"
    "e4,bad date,p3,unknown,o9,,urgent,Kept,\n",
    "conditions": "START,STOP,PATIENT,ENCOUNTER,CODE,DESCRIPTION\n2019-01-02,,p1,e1,I10,Hypertension\n",
    "medications": "START,PATIENT,ENCOUNTER,CODE,DESCRIPTION\n2019-01-02,p2,e2,7,Aspirin\n",
    "observations": "DATE,PATIENT,ENCOUNTER,CODE,DESCRIPTION,VALUE,UNITS\n"
    "2019-01-03,p1,e1,W,Weight,72.5,kg\n2019-01-03,p1,e1,S,Smoker,never,\n1950-01-01,p3,e4,H,Height,NaN,cm\n",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("sources")
    for name, body in FILES.items():
        (path / f"{name}.csv").write_text(body)
    return str(path)


@pytest.fixture(scope="module")
def star(spark, folder):
    return warehouse.load_star(warehouse.read_sources(spark, folder))


@pytest.fixture(scope="module")
def cleaned(star):
    return warehouse.clean_star(star)


def test_sources_are_read_by_name_and_may_be_missing(spark, folder):
    patients = tables.read_source(spark, folder, "patients")
    assert patients.columns == schemas.SOURCES["patients"].names
    assert patients.filter("Id = 'p2'").first()["ZIP"] is None
    assert tables.read_source(spark, folder, "allergies").count() == 0
    assert tables.read_source(spark, folder, "medications").select("PAYER").first()[0] is None


def test_dimensions(star):
    rows = values(star["dim_patient"], "patient_key", "full_name", "birthdate", "zip")
    assert [r[0] for r in rows] == [1, 2, 3, 4]
    assert ("Zoe Lee", None, None) in [r[1:] for r in rows]
    assert ("Abe604 Smith12", datetime.date(1960, 5, 1), "78701") in [r[1:] for r in rows]
    for name, schema in schemas.STAR.items():
        assert set(star[name].columns) == set(schema.names)


def test_facts(star):
    facts = {r["event_key"]: r for r in star["fact_patient_events"].collect()}
    by_encounter = {(r["event_category"], r["encounter_id"], r["code"]): r for r in facts.values()}
    assert sorted(facts) == list(range(1, 9))
    first = by_encounter["Encounter", "e1", "wellness"]
    assert first["patient_key"] == 2 and first["org_key"] == 3 and first["payer_key"] == 2
    assert first["date_key"] == datetime.date(2019, 1, 1) and str(first["cost"]) == "100.01"
    kept = by_encounter["Encounter", "e4", "urgent"]
    assert (kept["date_key"], kept["provider_key"], kept["org_key"], kept["payer_key"], kept["cost"]) == (None,) * 5
    assert by_encounter["Encounter", "e2", "urgent"]["description"] == 'Said "ouch"'
    assert by_encounter["Diagnosis", "e1", "I10"]["description"] == "Hypertension"
    assert str(by_encounter["Observation", "e1", "W"]["numeric_value"]) == "72.50"
    assert by_encounter["Observation", "e1", "S"]["numeric_value"] is None
    assert by_encounter["Observation", "e4", "H"]["numeric_value"] is None


def test_date_dimension(star):
    rows = {r["date_key"]: r for r in star["dim_date"].collect()}
    assert len(rows) == 4 and None not in rows
    day = rows[datetime.date(2019, 1, 2)]
    assert (day["year"], day["month"], day["month_name"], day["day_of_week"]) == (2019, 1, "January", "Wednesday")


def test_repair_and_impute_dates(spark):
    bad = spark.createDataFrame([(datetime.date(2020, 2, 29), 0, 0, None, None)], schemas.STAR["dim_date"])
    assert values(dates.repair_dates(bad)) == [(datetime.date(2020, 2, 29), 2020, 2, "February", "Saturday")]
    filled = spark.range(50).select(dates.impute_date(F.lit(None).cast("date"), F.col("id")).alias("d"))
    assert all(datetime.date(2020, 1, 1) <= r["d"] <= datetime.date(2022, 9, 26) for r in filled.collect())


def test_cleaning(cleaned):
    patients = {r["patient_key"]: r for r in cleaned["dim_patient"].collect()}
    assert "full_name" not in cleaned["dim_patient"].columns
    cities = sorted(r["city"] for r in patients.values())
    assert cities == ["AUSTIN", "LAREDO", "UNKNOWN", "WACO"]
    assert {r["state"] for r in patients.values()} == {"TX"}
    assert all(r["gender"] in ("M", "F") and r["birthdate"] for r in patients.values())
    zips = {r["city"]: r["zip"] for r in patients.values()}
    assert zips["AUSTIN"] == "78701" and zips["LAREDO"] == "78040"
    assert zips["WACO"] in clean.FALLBACK_ZIPS and zips["UNKNOWN"] in clean.FALLBACK_ZIPS


def test_provider_names_are_repaired_before_dedup(cleaned):
    providers = {r["provider_key"]: r for r in cleaned["dim_provider"].collect()}
    assert providers[1]["name"] == "Abe Smith" and 2 not in providers
    assert providers[3]["name"].startswith("Dr. ") and providers[3]["specialty"] == "General Practice"
    assert not any(n["name"] in clean.PLACEHOLDER_NAMES for n in providers.values())


def test_three_way_duplicates_and_repointing(star, cleaned):
    assert values(cleaned["dim_organization"], "org_key") == [(1,), (4,)]
    assert values(cleaned["dim_payer"], "payer_key") == [(1,)]
    facts = cleaned["fact_patient_events"]
    assert facts.count() == star["fact_patient_events"].count()
    assert values(facts.filter("org_key is not null").select("org_key").distinct()) == [(1,)]
    report = values(warehouse.reports(cleaned)["references"])
    assert [r[1:] for r in report] == [(0, 0)] * 5


def test_cleaning_twice_changes_nothing(cleaned):
    again = warehouse.clean_star(cleaned)
    for name in schemas.STAR:
        assert values(again[name]) == values(cleaned[name])


def test_null_key_parts_are_never_duplicates(spark):
    dim = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "b", "x"), (4, " B", "X ")], "k long, n string, c string")
    assert values(dedup.replaced_keys(dim, "k", ["n", "c"])) == [(4, 3)]


def test_dedup_without_broadcast(spark, no_broadcast, star):
    tidy = dedup.dedup_star({**star, "dim_organization": clean.standardise_place(star["dim_organization"])})
    assert values(tidy["dim_organization"], "org_key") == [(1,), (4,)]
    assert values(tidy["fact_patient_events"].filter("encounter_id = 'e1' and org_key is not null"), "org_key") == [(1,)]


def test_name_hook_runs_only_for_placeholders(spark):
    providers = spark.createDataFrame(
        [(1, "Dr. XYZ", "Heart"), (2, None, "Skin"), (3, "Ann", "Eye"), (4, "dr. unknown", "fail")],
        schemas.STAR["dim_provider"],
    )

    def model(specialty):
        assert not (specialty == "Eye").any()
        return specialty.map(lambda s: None if s == "fail" else f'"Jo {s}."')

    got = dict(values(clean.fill_names(providers, model), "provider_key", "name"))
    assert got == {1: "Dr. Jo Heart", 2: "Dr. Jo Skin", 3: "Ann", 4: "Dr. Unknown"}
    named = spark.createDataFrame([("Dr Who",), ("Dr. Who",), (" Who ",)], "n string")
    assert [r[0] for r in named.select(clean.doctor_name(F.col("n"))).collect()] == ["Dr. Who"] * 3


def test_reports(star, cleaned):
    counts = dict(values(quality.table_counts(star)))
    assert counts["Total Patients"] == 4 and counts["Patients with Gender"] == 3 and counts["Total Events"] == 8
    before = {r["check"]: r["status"] for r in quality.null_checks(star).collect()}
    assert before["NULL Provider Specialties"] == "FAIL (1)" and before["NULL Cities (Orgs)"] == "FAIL (1)"
    after = quality.null_checks(cleaned)
    assert quality.all_clean(after).first()[0] is True
    as_of = F.lit("2024-01-01").cast("date")
    checks = dict(values(quality.validations(cleaned, as_of), "check", "n"))
    assert checks["Birthdate in Future"] == 1 and checks["Event Before Birth"] >= 1 and checks["Invalid Zip Format"] == 0
    profile = quality.null_profile(star["dim_patient"]).first()
    assert (profile["total"], profile["null_gender"], profile["pct_gender"]) == (4, 1, 25.0)
    assert dict(values(quality.duplicate_profile(star)))["payer"] == 1


def test_sinks(spark, tmp_path, star):
    path = str(tmp_path / "wh")
    sinks.reset_star(spark, path)
    assert tables.read_star(spark, path)["dim_payer"].count() == 0
    sinks.write_star(star, path)
    back = tables.read_star(spark, path)
    for name, schema in schemas.STAR.items():
        assert values(back[name], *schema.names) == values(star[name], *schema.names)
    dim = str(tmp_path / "dates")
    sinks.insert_if_absent(star["dim_date"], dim, "date_key")
    sinks.insert_if_absent(star["dim_date"], dim, "date_key")
    assert spark.read.parquet(dim).count() == 4
    export = str(tmp_path / "dim_patient.csv")
    sinks.export_csv(star["dim_patient"].coalesce(1), export)
    body = next(open(f"{export}/{f}").read() for f in os.listdir(export) if f.endswith(".csv"))
    assert body.startswith('"patient_key","full_name"') and ',"NULL",' in body
    again = tables.read_extract(spark, str(tmp_path), "dim_patient")
    assert values(again, "patient_key", "city") == values(star["dim_patient"].withColumn("city", F.col("city")), "patient_key", "city")


RECORDS = {
    "1500": {
        "dim_patient": {"full_name": "Ann 'O' \\ \"x\"", "gender": "F", "birthdate": "1954-05-26", "city": "Austin"},
        "dim_provider": {"name": "Dr. A", "specialty": None},
        "dim_organization": {"name": "Org"},
        "dim_payer": {"name": "Pay"},
        "fact_patient_events": [
            {"event_category": "Observation", "event_date": "2023-10-12", "numeric_value": 145.0, "units": "mmHg"},
            {"event_category": "Diagnosis", "event_date": "2023-10-12", "code": "I10", "cost": 15.5},
        ],
    },
    "1501": {"dim_provider": {"name": "B"}, "fact_patient_events": []},
    "999": {"dim_payer": {"name": "C"}, "fact_patient_events": [{"event_category": "Allergy", "event_date": ""}]},
}


def test_flatten_nested_records(spark, tmp_path):
    path = tmp_path / "records.json"
    path.write_text(json.dumps(RECORDS))
    records = tables.read_record_map(spark, str(path))
    t = flatten.flatten(records, {"patient_key": 11})
    assert values(t["dim_patient"], "patient_key", "full_name") == [(11, None), (12, "Ann 'O' \\ \"x\""), (13, None)]
    assert values(t["dim_payer"], "payer_key", "name") == [(1, "C"), (2, "Pay"), (3, None)]
    facts = values(t["fact_patient_events"], "event_key", "patient_key", "payer_key", "event_category", "date_key")
    day = datetime.date(2023, 10, 12)
    assert facts == [(1, 11, 1, "Allergy", None), (2, 12, 2, "Observation", day), (3, 12, 2, "Diagnosis", day)]
    assert values(t["dim_date"], "date_key", "month_name") == [(day, "October")]


def test_merge_records_into_a_star(spark, tmp_path, star):
    path = tmp_path / "records.json"
    path.write_text(json.dumps(RECORDS))
    merged = warehouse.merge_star(star, tables.read_record_map(spark, str(path)))
    assert merged["fact_patient_events"].count() == 11
    assert merged["dim_payer"].select(F.max("payer_key")).first()[0] == 5
    report = warehouse.reports(merged)["references"]
    assert [r[1:] for r in values(report)] == [(0, 0)] * 5


def test_extraction_with_rules_and_rejects(spark):
    rows = [
        (0, "s0", "A 45-year-old female. Weight: 130 pounds. Takes Lisinopril 10 mg on 2023-10-12"),
        (1, "s1", None),
        (2, "s2", "boom"),
    ]
    df = spark.createDataFrame(rows, "source_row_id long, sample_name string, transcription string")
    good, rejects = extract.split_responses(extract.responses(df, "transcription"))
    assert rejects.count() == 0
    records = {r["record_id"]: r["rec"] for r in extract.records_from(good).collect()}
    first = records["1500"]
    assert first["dim_patient"]["gender"] == "F" and first["dim_patient"]["birthdate"] == "1979-01-01"
    events = [(e["event_category"], e["description"], e["numeric_value"], e["units"]) for e in first["fact_patient_events"]]
    assert events == [("Observation", "weight", 130.0, "pounds"), ("Medication", "lisinopril", 10.0, "mg")]
    assert records["1501"]["fact_patient_events"] == [] and records["1501"]["dim_patient"]["state"] == "TX"
    assert records["1502"]["metadata"]["source_row_id"] == 2

    def model(texts):
        if (texts == "boom").any():
            raise ValueError
        return texts.map(lambda t: "not json" if t is None else '{"dim_payer": {"name": "P"}}')

    good, rejects = extract.split_responses(extract.responses(df, "transcription", model))
    assert values(rejects, "source_row_id", "error") == [(1, None), (2, "ValueError: ")]
    assert values(extract.records_from(good), "record_id") == [("1500",)]


def test_documents(cleaned):
    docs = documents.build_corpus(cleaned)
    rows = {r["doc_id"]: r for r in docs.collect()}
    facts = cleaned["fact_patient_events"].count()
    assert len(rows) == 2 * facts + 4 + 2 + cleaned["dim_provider"].count() + 1
    event = next(r for r in rows.values() if "Weight" in r["content"] and r["doc_id"] % 8 == 0)
    assert event["content"].startswith("Observation for Patient ") and "Value: 72.50 kg. Date: 2019-01-03. " in event["content"]
    assert "provider_id" not in event["metadata"] and event["provider_id"] is None
    kept = next(r for r in rows.values() if "Kept" in r["content"] and r["doc_id"] % 8 == 1)
    assert kept["content"].endswith("had encounter on unknown. Kept") and kept["metadata"]["date"] == ""
    payer = rows[8 + 5]
    assert payer["content"].startswith("Payer 1: Aetna. Covers 1 patients with 1 total events. Patient IDs: ")
    idle = [r["content"] for r in rows.values() if r["type"] == "patient_profile" and "No recorded" in r["content"]]
    assert len(idle) == 1
    named = documents.build_corpus(cleaned, null_text="nan")
    assert named.filter(F.contains("content", F.lit(" on nan. Kept"))).count() == 1


def test_profile_lists_ten_patients_first_seen_first(spark):
    facts = spark.createDataFrame(
        [(100 - i, i, 1, "c") for i in range(1, 15)] + [(200, 14, 1, "c")],
        "event_key long, patient_key long, provider_key long, event_category string",
    )
    providers = spark.createDataFrame([(1, "N", "S"), (2, "M", "S")], schemas.STAR["dim_provider"])
    got = {r["doc_id"]: r["content"] for r in documents.provider_profiles(providers, facts).collect()}
    assert got[8 + 3] == (
        "Provider 1: N, Specialty: S. Treated 14 patients with 15 total events. "
        "Patient IDs: 14, 13, 12, 11, 10, 9, 8, 7, 6, 5."
    )
    assert got[16 + 3] == "Provider 2: M, Specialty: S. Treated 0 patients with 0 total events. "


def test_functions_of_the_caller(spark):
    """Random answers are asked for once; failures give the name for failures or a reject."""
    import uuid

    import pandas as pd

    from wardstar.operators import clean

    rows = [(i, None if i % 2 else "Dr. Real", "Surgery") for i in range(8)]
    providers = spark.createDataFrame(rows, schemas.STAR["dim_provider"])
    named = clean.fill_names(providers, lambda s: pd.Series([uuid.uuid4().hex for _ in s]))
    assert values(named) == values(named)
    assert len({r["name"] for r in named.collect()}) == 5

    def broken(specialties):
        raise RuntimeError("no model")

    assert {r["name"] for r in clean.fill_names(providers, broken).collect()} == {"Dr. Real", "Dr. Unknown"}

    notes = spark.createDataFrame([(i, "s", f"note {i}") for i in range(6)], "source_row_id long, sample_name string, transcription string")

    def answer(texts):
        if texts.iloc[0] == "note 3":
            raise RuntimeError("quota")
        return texts.map(lambda t: '{"dim_payer": {"name": "' + uuid.uuid4().hex + '"}}')

    good, rejects = extract.split_responses(extract.responses(notes, "transcription", answer))
    assert values(good.select("rec")) == values(good.select("rec"))
    assert values(rejects, "source_row_id", "error") == [(3, "RuntimeError: quota")]
    batch, left = extract.split_responses(extract.responses(notes.coalesce(1), "transcription", broken, batched=True))
    assert batch.count() == 0 and {r["error"] for r in left.collect()} == {"RuntimeError: no model"}


def test_staged_tables_are_released(spark, monkeypatch):
    import os
    import uuid

    from wardstar.session import release, run_dir, stage

    stage(spark.range(3), "kept")
    folder = run_dir(spark).removeprefix("file:")
    assert any(name.startswith("kept-") for name in os.listdir(folder))
    elsewhere = f"{run_dir(spark)}-{uuid.uuid4().hex}"
    monkeypatch.setattr("wardstar.session.run_dir", lambda _: elsewhere)
    stage(spark.range(3), "gone")
    assert os.path.isdir(elsewhere)
    release(spark)
    assert not os.path.exists(elsewhere) and os.path.isdir(folder)
