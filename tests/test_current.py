"""Current-state tables: equal to a build from everything, and no exchange of
what is already there."""

import os
import re

import pytest
from pyspark.sql import functions as F

from bundlelake.operators import marts as M
from bundlelake.operators import quality as Q
from bundlelake.plans import current as C
from bundlelake.plans import versions as V
from bundlelake.plans.pipeline import run_pipeline
from bundlelake.schemas import STAGING_SPECS
from bundlelake.testing import registry
from bundlelake.testing.build import Build
from bundlelake.testing.files import write_files
from bundlelake.testing.fixtures import bundle_files, fixture_landing

SF, AS_OF = "/root/testdata/sf0.001", "2024-12-31"
MARCH = "timestamp'2024-02-15 00:00:00'"


def rows(df):
    return sorted(df.select([c for c in df.columns if not c.startswith("dbt_")]).collect(), key=repr)


def same(state, full, names=None, **kw):
    for name, df in state.tables(AS_OF, **kw).items():
        if names is None or name in names:
            assert rows(df) == rows(full[name].select(df.columns)), name


@pytest.fixture(scope="module")
def fixture(spark, tmp_path_factory):
    """(build of both loads, state root with both loads as generations)."""
    build, root = Build.from_tables(spark, SF), str(tmp_path_factory.mktemp("state"))
    C.apply(spark, root, build.typed.where(f"ingestion_timestamp < {MARCH}"), [("1", 1)], "2023-06-30", buckets=2)
    C.apply(spark, root, build.typed.where(f"ingestion_timestamp > {MARCH}"), [("2", 1)], AS_OF)
    return build, root


def test_equal_to_a_full_build(spark, fixture):
    build, root = fixture
    same(C.at_generation(spark, root), build.layers())
    # the generation before is still there as it was
    same(C.at_generation(spark, root, 1), Build.from_tables(spark, SF, loads=(1,)).layers())


def test_only_new_rows_are_written(spark, fixture):
    build, root = fixture
    state = C.at_generation(spark, root, 2)
    for m, spec in STAGING_SPECS.items():
        new = build.typed.where(f"ingestion_timestamp > {MARCH}").where(F.col("resource_type") == spec["resource_type"]).count()
        assert state.rows(m).where("_gen = 2").count() == new
    assert 0 < state.rows("fct_vitals").where("_gen = 2").count() < build.mart("fct_vitals").count() / 2


def test_no_exchange_of_what_is_there(spark, fixture):
    _, root = fixture
    state = C.at_generation(spark, root, 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = spark.range(50).select(F.concat(F.lit("obs-"), "id").alias("_id"))
        found = C.among(state.rows("stg_observations").where("observation_id is not null"), "observation_id", ids)
        facts = state.merged("stg_observations", state.rows("stg_observations").join(ids, F.col("observation_id") == F.col("_id"), "left_semi"))
        joined = facts.join(state.staging("stg_patients").select("patient_id", "gender"), "patient_id", "left")
        for df, moved in ((state.mart("fct_vitals"), 0), (state.staging("stg_encounters"), 0), (joined, 2)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == moved, plan  # of 50 ids, and of the facts found with them
            assert "Bucketed: true" in plan
        assert found.count() >= 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_run_that_broke_off_is_repeated(spark, tmp_root, monkeypatch):
    typed = Build.from_tables(spark, SF).typed
    first, second = typed.where(f"ingestion_timestamp < {MARCH}"), typed.where(f"ingestion_timestamp > {MARCH}")
    C.apply(spark, tmp_root, first, [("1", 1)], AS_OF, buckets=2)
    append = C.State.append

    def lost(self, table, df):
        if table == "fct_vitals":
            raise RuntimeError("lost")
        append(self, table, df)

    monkeypatch.setattr(C.State, "append", lost)
    bad = second.withColumn("stg_patients", F.when(F.col("stg_patients").isNotNull(), F.col("stg_patients").withField("city", F.lit("nowhere"))))
    with pytest.raises(RuntimeError):
        C.apply(spark, tmp_root, bad, [("2", 1)], AS_OF)
    monkeypatch.undo()
    loads = spark.createDataFrame([("1", 1), ("2", 1)], "load string, n long")
    assert C.at_generation(spark, tmp_root).gen == 1 and C.pending_loads(spark, tmp_root, loads) == [("2", 1)]
    state = C.apply(spark, tmp_root, second, [("2", 1)], AS_OF)
    assert state.gen == 3 and state.void == (2,) and C.pending_loads(spark, tmp_root, loads) == []
    folded = C.compact(spark, tmp_root, buckets=3)
    assert folded.gen == 4 and folded.buckets == 3 and folded.rows("stg_patients").count() == Build.from_tables(spark, SF).stg("stg_patients").count()
    same(C.at_generation(spark, tmp_root), Build.from_tables(spark, SF).layers())
    assert C.pending_loads(spark, tmp_root, loads) == [] and C.at_generation(spark, tmp_root, 3).buckets == state.buckets


def bundle(*resources):
    return '{"entry":[' + ",".join('{"resource":' + r + "}" for r in resources) + "]}"


def test_moved_encounters_late_loads_and_rows_without_ids(spark, tmp_root):
    first = fixture_landing(spark, SF, loads=(1,))
    enc = '{"resourceType":"Encounter","id":"enc-1","status":"%s","subject":{"reference":"urn:uuid:pat-%s"}}'
    # one load newer than all, then one that came late: stamped before it
    late = [("m2", bundle(enc % ("stale", 3)), "2023-01-01"), ("m1", bundle(enc % ("moved", 2)), "2024-05-01"),
            ("p", bundle('{"resourceType":"Patient","id":"pat-1","gender":"female","birthDate":"1950-01-01","address":[{"city":"Elsewhere"}]}'), "2024-05-02"),
            ("n1", bundle('{"resourceType":"Patient","gender":"other"}', '{"resourceType":"Observation","status":"a"}'), "2024-05-03"),
            ("n2", bundle('{"resourceType":"Patient","gender":"male"}', '{"resourceType":"Observation","status":"b"}'), "2024-05-04")]
    landing = first
    C.apply(spark, tmp_root, Build(spark, first).typed, [("0", 1)], AS_OF, buckets=2)
    for part in (late[1:], late[:1]):
        more = spark.createDataFrame([(f"raw/fhir/late/{name}.json", data, day) for name, data, day in part], "file_path string, data string, t string")
        more = more.selectExpr("file_path", "data", "cast(t as timestamp) ingestion_timestamp")
        landing = landing.unionByName(more)
        state = C.apply(spark, tmp_root, Build(spark, more).typed, [(part[0][0], len(part))], AS_OF)
    full = Build(spark, landing, as_of_date=AS_OF)
    same(state, full.staging | full.marts)
    assert state.mart("fct_encounters").where("encounter_id = 'enc-1'").first()["patient_id"] == "pat-2"
    assert {r.patient_city for r in state.mart("fct_encounters").where("patient_id = 'pat-1'").collect()} == {"Elsewhere"}
    # the report from suspects is the report from everything
    checks = Q.ALL_CHECKS
    key = lambda r: (r.model, r.test, r.column)
    want = sorted(Q.audit(state.tables(AS_OF), checks).collect(), key=key)
    assert sorted(C.audit(state, checks, AS_OF).collect(), key=key) == want
    assert {key(r) for r in want if r.violations} >= {("stg_patients", "not_null", "patient_id"), ("stg_observations", "not_null", "patient_id"),
                                                      ("fct_vitals", "relationships", "patient_id")}


def test_pipeline_publishes_generations(spark, tmp_root):
    raw, root = os.path.join(tmp_root, "raw"), os.path.join(tmp_root, "lake")
    checks = [c for c in Q.ALL_CHECKS if c.test != "relationships"]  # the fixtures have dangling subjects
    for load in (1, 2):
        write_files(bundle_files(spark, SF, load).select(F.col("file_path").alias("path"), F.col("data").alias("body")), raw).count()
        report = run_pipeline(spark, raw, root, f"v{load}", as_of_date=AS_OF, checks=checks, dedup_allergies=True, marts="incremental")
        assert report.count() == len(checks) and report.first().published
    full = Build.from_tables(spark, SF)
    for name in ("dim_patients", "fct_encounters"):
        cols = [c for c in full.mart(name).columns if c != "ingested_at" and not c.startswith("dbt_")]
        assert rows(V.read_version(spark, root, name).select(cols)) == rows(full.mart(name).select(cols))
    before = V.read_version(spark, root, "fct_encounters", "v1")
    assert before.count() == Build.from_tables(spark, SF, loads=(1,)).mart("fct_encounters").count()
    # a full refresh from fewer files leaves nothing of the others behind
    some = os.path.join(tmp_root, "some")
    write_files(bundle_files(spark, SF, 1).where("file_path like '%pat-1%'").select(F.col("file_path").alias("path"), F.col("data").alias("body")), some).count()
    run_pipeline(spark, some, root, "v3", mode="full_refresh", as_of_date=AS_OF, checks=checks, dedup_allergies=True)
    run_pipeline(spark, some, root, "v4", as_of_date=AS_OF, checks=checks, dedup_allergies=True, marts="incremental")
    assert V.current_label(spark, root) == "v4"
    left = {r.patient_id for r in V.read_version(spark, root, "dim_patients").collect()}
    assert left and all(re.match("pat-1", x) for x in left)


def test_nothing_is_broadcast_by_file_size(spark, tmp_root):
    """Compressed files say little of what a broadcast would send through the
    driver: patients and ids are moved by key, however small they look."""
    facts = [(f"c-{i}", f"p-{i % 5}", "e", "active", "confirmed", "C1", "d", None, None, None) for i in range(40)] + [("c-x", None, *[None] * 8)]
    columns = "condition_id string, patient_id string, encounter_id string, clinical_status string, verification_status string, condition_code string, condition_description string, onset_date date, abatement_date date, ingested_at timestamp"
    spark.createDataFrame(facts, columns).write.parquet(f"{tmp_root}/f")
    spark.createDataFrame([(f"p-{i}", "male", "White", None) for i in (0, 1, 1, 2)], "patient_id string, gender string, race string, birth_date date").write.parquet(f"{tmp_root}/p")
    fact, patients = spark.read.parquet(f"{tmp_root}/f"), spark.read.parquet(f"{tmp_root}/p")
    ids = patients.select(F.col("patient_id").alias("_id")).distinct()
    mart = M.fct_conditions(fact, patients.hint("merge"))  # as the state gives them
    lost = Q.relationships(fact, "patient_id", patients, "patient_id")
    some = C.among(fact, "patient_id", ids)
    report = Q.audit({"fct_conditions": fact, "dim_patients": patients}, [c for c in Q.MART_CHECKS if c.model == "fct_conditions" and c.to])
    for df in (mart, lost, some, report):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, plan
    assert (mart.count(), lost.count(), some.count()) == (49, 16, 25)  # p-1 twice; p-3 and p-4 unknown; one without a patient
    assert [r["violations"] for r in report.collect()] == [16]


def test_a_state_of_one_mart_keeps_that_mart_and_what_it_reads(spark, fixture, tmp_root):
    build, _ = fixture
    for mart in ("fct_vitals", "dim_patients"):
        root, typed = os.path.join(tmp_root, mart), build.typed_for(mart)
        C.apply(spark, root, typed.where(f"ingestion_timestamp < {MARCH}"), [("1", 1)], "2023-06-30", buckets=2, marts=[mart])
        state = C.apply(spark, root, typed.where(f"ingestion_timestamp > {MARCH}"), [("2", 1)], AS_OF)
        assert set(state.tables()) == {mart} | M.sources(mart)
        for s in (state, C.at_generation(spark, root), C.compact(spark, root)):
            same(s, build.layers())
        # no other table was written
        helper = C.LINKS if mart == "fct_vitals" else C.DAYS
        assert set(os.listdir(os.path.join(root, "state", "era-1"))) == {mart, helper} | M.sources(mart)
        with pytest.raises(ValueError):
            C.apply(spark, root, typed.limit(0), marts=["fct_conditions"])


def test_a_query_of_one_mart_builds_the_state_of_no_other(spark, monkeypatch):
    kept = []
    apply = C.apply
    monkeypatch.setattr(registry.CUR, "apply", lambda *a, **kw: kept.append(apply(*a, **kw)) or kept[-1])
    monkeypatch.setattr(registry, "_STATES", {})
    for query, mart in (("incremental_fct_procedures", "fct_procedures"), ("rollup_top_conditions", "fct_conditions")):
        kept.clear()
        assert registry.QUERIES[query](spark, SF).count()
        assert [s.marts for s in kept] == [[mart]] * 2
