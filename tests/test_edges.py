"""Hand-made edge bundles (FIXTURES.md section 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bundlelake.operators import marts as M
from bundlelake.operators import serving as S
from bundlelake.operators.entries import bundle_entries, malformed_bundles
from bundlelake.operators.staging import stage, stage_typed, typed_entries
from bundlelake.schemas import LANDING_SCHEMA


def landing(spark, rows):
    """rows: (file_path, data, 'YYYY-MM-DD HH:MM:SS')"""
    df = spark.createDataFrame([(p, d, t) for p, d, t in rows], "file_path string, data string, t string")
    return df.select("file_path", "data", F.col("t").cast("timestamp").alias("ingestion_timestamp"))


def bundle(*resources):
    import json
    return json.dumps({"resourceType": "Bundle", "entry": [
        r if not isinstance(r, dict) or "resource" in r else {"fullUrl": "urn:uuid:" + str(r.get("id")), "resource": r}
        for r in resources]})


T1 = "2024-02-01 00:00:00"
T2 = "2024-03-01 00:00:00"


@pytest.mark.parametrize("data", ['{"resourceType":"Bundle"}', '{"entry":[]}', '{"entry":null}'])
def test_entry_shapes_without_rows(spark, data):
    assert bundle_entries(landing(spark, [("a.json", data, T1)])).count() == 0
    assert malformed_bundles(landing(spark, [("a.json", data, T1)])).count() == 0


@pytest.mark.parametrize("data", ['{"entry":5}', '{"entry":{"k":1}}'])
def test_entry_that_is_no_array_fails_or_is_kept_aside(spark, data):
    lnd = landing(spark, [("a.json", data, T1)])
    with pytest.raises(Exception):
        bundle_entries(lnd).count()
    assert bundle_entries(lnd, "quarantine").count() == 0
    assert [r.reason for r in malformed_bundles(lnd).collect()] == ["entry is not an array"]


def test_null_element_dropped_by_type_filter(spark):
    data = '{"entry":[null, {"resource":{"resourceType":"Patient","id":"p1"}}]}'
    e = bundle_entries(landing(spark, [("a.json", data, T1)]))
    assert e.count() == 2
    assert stage(e, "stg_patients").count() == 1


def test_missing_index_and_object_at_scalar_path(spark):
    data = bundle({"resourceType": "Patient", "id": "p1", "name": [], "gender": {"x": 1},
                   "maritalStatus": {"text": "[bracketed]"}})
    p = stage(bundle_entries(landing(spark, [("a.json", data, T1)])), "stg_patients").first()
    assert p.family_name is None and p.given_name is None
    assert p.gender is None  # object at a scalar path -> NULL
    assert p.marital_status == "[bracketed]"  # a real string that starts with '[' is kept


def test_malformed_json_fails_or_quarantines(spark):
    lnd = landing(spark, [("bad.json", "{bad", T1), ("ok.json", bundle({"resourceType": "Patient", "id": "p"}), T1)])
    with pytest.raises(Exception):
        bundle_entries(lnd).count()
    assert bundle_entries(lnd, on_malformed="quarantine").count() == 1
    assert [r.file_path for r in malformed_bundles(lnd).collect()] == ["bad.json"]


def test_duplicate_keys_raise(spark):
    with pytest.raises(Exception):
        bundle_entries(landing(spark, [("d.json", '{"a":1,"a":2}', T1)])).count()


def test_bad_number_and_date_raise(spark):
    obs = bundle({"resourceType": "Observation", "id": "o", "valueQuantity": {"value": "x"}})
    with pytest.raises(Exception):
        stage(bundle_entries(landing(spark, [("a.json", obs, T1)])), "stg_observations").collect()
    pat = bundle({"resourceType": "Patient", "id": "p", "birthDate": "xx"})
    with pytest.raises(Exception):
        stage(bundle_entries(landing(spark, [("a.json", pat, T1)])), "stg_patients").collect()


def test_dedup_latest_and_tie_break(spark):
    rows = [("a.json", bundle({"resourceType": "Patient", "id": "p", "gender": "male"}), T1),
            ("b.json", bundle({"resourceType": "Patient", "id": "p", "gender": "female"}), T1),
            ("c.json", bundle({"resourceType": "Patient", "id": "p", "gender": "other"}), "2024-01-01 00:00:00")]
    p = stage(bundle_entries(landing(spark, rows)), "stg_patients").collect()
    assert len(p) == 1 and p[0].gender == "female" and p[0].file_path == "b.json"
    # newer load beats a greater path
    rows.append(("0.json", bundle({"resourceType": "Patient", "id": "p", "gender": "unknown"}), T2))
    p = stage(bundle_entries(landing(spark, rows)), "stg_patients").collect()
    assert p[0].gender == "unknown"
    assert "rn" not in p[0].asDict() and "_pos" not in p[0].asDict()


def test_dedup_is_idempotent(spark):
    rows = [(f"{i}.json", bundle({"resourceType": "Encounter", "id": f"e{i % 3}", "status": str(i)}), T1)
            for i in range(9)]
    once = stage(bundle_entries(landing(spark, rows)), "stg_encounters").drop("dbt_processed_at")
    from bundlelake.operators.staging import dedup_latest
    twice = dedup_latest(once.withColumn("_pos", F.lit(0)), "encounter_id").drop("_pos")
    assert sorted(once.collect()) == sorted(twice.collect())


def test_offset_dates_and_instants(spark):
    enc = bundle({"resourceType": "Encounter", "id": "e", "period": {"start": "2015-03-02T23:15:30-05:00"}})
    obs = bundle({"resourceType": "Observation", "id": "o", "effectiveDateTime": "2015-03-02T23:15:30-05:00"})
    e = bundle_entries(landing(spark, [("a.json", enc, T1), ("b.json", obs, T1)]))
    assert stage(e, "stg_encounters").first().start_time == dt.date(2015, 3, 2)
    o = stage(e, "stg_observations").select(F.col("effective_date").cast("string").alias("s")).first()
    assert o.s == "2015-03-03 04:15:30"


def test_reference_prefix_cases(spark):
    rows = [("a.json", bundle({"resourceType": "Encounter", "id": "e1", "subject": {"reference": "urn:uuid:urn:uuid:a"}}), T1),
            ("b.json", bundle({"resourceType": "Encounter", "id": "e2", "subject": {"reference": "Patient?identifier=1"}}), T1),
            ("c.json", bundle({"resourceType": "Encounter", "id": "e3"}), T1)]
    got = {r.encounter_id: r.patient_id for r in stage(bundle_entries(landing(spark, rows)), "stg_encounters").collect()}
    assert got == {"e1": "a", "e2": "Patient?identifier=1", "e3": None}


def test_typed_entries_equal_per_model_staging(spark):
    rows = [("a.json", bundle({"resourceType": "Patient", "id": "p", "gender": "male", "birthDate": "2000-01-02"},
                               {"resourceType": "Condition", "id": "c", "subject": {"reference": "urn:uuid:p"},
                                "onsetDateTime": "2020-01-01T00:00:00Z"}), T1)]
    e = bundle_entries(landing(spark, rows))
    ty = typed_entries(e)
    for m in ("stg_patients", "stg_conditions", "stg_observations"):
        a = stage(e, m).drop("dbt_processed_at").collect()
        b = stage_typed(ty, m).drop("dbt_processed_at").collect()
        assert sorted(a) == sorted(b)


def test_condition_lifecycle_and_negative_age(spark):
    pats = spark.createDataFrame([("p", "male", "White", dt.date(2030, 6, 1))],
                                 "patient_id string, gender string, race string, birth_date date")
    conds = spark.createDataFrame(
        [("c", "p", None, None, None, None, None, dt.date(2020, 5, 1), dt.date(2019, 1, 1), None)],
        "condition_id string, patient_id string, encounter_id string, clinical_status string, "
        "verification_status string, condition_code string, condition_description string, onset_date date, "
        "abatement_date date, ingested_at timestamp")
    r = M.fct_conditions(conds, pats).first()
    assert r.condition_lifecycle_status == "Resolved"
    assert r.patient_age_at_onset == -10


def test_feb29_birth_and_no_encounters(spark):
    pats = spark.createDataFrame([("p", dt.date(2000, 2, 29))], "patient_id string, birth_date date")
    for c in ["given_name", "family_name", "gender", "address_line", "city", "state", "postal_code", "country",
              "phone_number", "primary_language", "race", "ethnicity", "marital_status"]:
        pats = pats.withColumn(c, F.lit(None).cast("string"))
    pats = pats.withColumn("ingested_at", F.current_timestamp())
    encs = spark.createDataFrame([], "patient_id string, start_time date")
    r = M.dim_patients(pats, encs, "2001-02-28").first()
    assert r.age_years == 1  # a birthday of Feb 29 falls on the 28th in other years
    assert r.total_encounters == 0 and r.first_encounter_date is None


def test_vitals_having_more_than_ten(spark):
    rows = [("Obs a", 1.0, "kg")] * 10 + [("Obs b", 2.0, "kg")] * 11
    df = spark.createDataFrame(rows, "observation_description string, value_quantity double, value_unit string")
    got = S.vitals_summary(df).collect()
    assert [(r.observation_description, r.sample_size) for r in got] == [("Obs b", 11)]


def test_landing_schema_fixed():
    assert LANDING_SCHEMA.fieldNames() == ["file_path", "data", "ingestion_timestamp"]


def test_year_only_date_is_lenient(spark):
    """SURVEY 7.4-11: Spark's cast accepts '2015' (as 2015-01-01)."""
    pat = bundle({"resourceType": "Patient", "id": "p", "birthDate": "2015"})
    p = stage(bundle_entries(landing(spark, [("a.json", pat, T1)])), "stg_patients").first()
    assert p.birth_date == dt.date(2015, 1, 1)


def test_trend_puts_null_month_last(spark):
    df = spark.createDataFrame([(dt.date(2020, 5, 3),), (None,), (dt.date(2020, 1, 9),)], "start_time date")
    months = [r.month for r in S.encounter_trends(df).collect()]
    assert months == [dt.date(2020, 1, 1), dt.date(2020, 5, 1), None]


def test_quarantine_through_the_build(spark, tmp_path):
    from bundlelake.plans.pipeline import read_quarantine, update_typed_entries
    lnd = landing(spark, [("bad.json", "{bad", T1),
                          ("ok.json", bundle({"resourceType": "Patient", "id": "p", "gender": "male", "birthDate": "not-a-date"}), T1)])
    with pytest.raises(Exception):
        update_typed_entries(spark, lnd, str(tmp_path / "fail"))
    at = str(tmp_path / "typed")
    for _ in range(2):  # a poisoned value does not stop later runs, nor is it recorded twice
        p = stage_typed(update_typed_entries(spark, lnd, at, "quarantine"), "stg_patients").collect()
        assert [(r.patient_id, r.birth_date) for r in p] == [("p", None)]
    got = sorted((r.file_path, r.reason, r.column, r.text) for r in read_quarantine(spark, at).collect())
    assert got == [("bad.json", "not JSON", None, None), ("ok.json", "bad value", "birth_date", "not-a-date")]


def test_vital_lookup_takes_the_most_frequent_unit(spark):
    rows = [("HR", 60.0, "bpm")] * 100 + [("HR", 1.0, "aaa")] * 11
    df = spark.createDataFrame(rows, "observation_description string, value_quantity double, value_unit string")
    r = S.vital_lookup(S.vitals_summary(df), "HR").first()
    assert (r.value_unit, r.avg_value) == ("bpm", 60.0)


def test_extraction_is_two_plain_projections(spark):
    """No generator between them (evaluated expression by expression), and
    each path is walked once."""
    from bundlelake.operators.entries import bundle_entries
    from bundlelake.operators.staging import flatten, model_types, typed_entries
    from bundlelake.schemas import STAGING_SPECS
    landing = spark.createDataFrame([("f", "{}")], "file_path string, data string").selectExpr("*", "timestamp'2024-01-01' as ingestion_timestamp")
    entries = bundle_entries(landing)
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    try:
        for df in (typed_entries(model_types(entries)), flatten(entries, STAGING_SPECS["stg_observations"]["columns"])):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("Generate ") == 1  # of the entries
            assert plan.count("variant_get(entry#", 0) >= 1
            # as text: where it is first read, not again in the guard
            walks = [x for x in plan.replace("try_variant_get", "\n").split("\n") if "$.resource.valueQuantity.unit" in x and "StringType" in x.split("$.resource.valueQuantity.unit")[1][:40]]
            assert len(walks) == 1
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_resource_type_is_walked_to_once_per_projection(spark):
    data = ('{"entry":[{"resource":{"resourceType":"Patient"}},{"resource":{"resourceType":{"x":1}}},{"resource":{"resourceType":"{odd"}},'
             '{"resource":{"resourceType":["Patient"]}},{"resource":{"resourceType":7}},{"resource":{}},null]}')
    entries = bundle_entries(landing(spark, [("a.json", data, T1)]))
    assert [r["resource_type"] for r in entries.orderBy("pos").collect()] == ["Patient", None, "{odd", None, "7", None, None]
    plan = entries.select("pos", "resource_type", "entry")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("$.resource.resourceType, StringType") == 1
