"""Pipeline, audit gate, versions, incremental properties."""

import os

import pytest
from pyspark.sql import functions as F

from bundlelake.operators import incremental as INC
from bundlelake.operators import marts as M
from bundlelake.operators import quality as Q
from bundlelake.plans import versions as V
from bundlelake.testing import registry
from bundlelake.testing.build import Build
from bundlelake.plans.pipeline import run_pipeline
from bundlelake.schemas import STAGING_SPECS
from bundlelake.testing.files import write_files
from bundlelake.testing.fixtures import bundle_files, fixture_landing

SF = "/root/testdata/sf0.001"


def test_run_pipeline_gate_and_versions(spark, tmp_root):
    raw = os.path.join(tmp_root, "raw")
    files = bundle_files(spark, SF, 1).select(F.col("file_path").alias("path"), F.col("data").alias("body"))
    n_files = write_files(files, raw).count()
    assert n_files > 0
    root = os.path.join(tmp_root, "lake")
    # all 61 tests: dangling observation subjects fail the relationship test
    rep = run_pipeline(spark, raw, root, "v1", mode="full_refresh", as_of_date="2024-12-31")
    assert rep.count() == 61
    assert not rep.first().published
    assert V.current_label(spark, root) is None
    bad = {(r.model, r.test) for r in rep.where("violations > 0").collect()}
    assert bad == {("fct_vitals", "relationships")}
    # a gate without that test publishes
    checks = [c for c in Q.ALL_CHECKS if not (c.model == "fct_vitals" and c.test == "relationships")]
    rep2 = run_pipeline(spark, raw, root, "v2", mode="incremental", as_of_date="2024-12-31", checks=checks)
    assert rep2.first().published
    assert V.current_label(spark, root) == "v2"
    versions = {r.label: (r.published, r.current) for r in V.list_versions(spark, root).collect()}
    assert versions == {"v1": (False, False), "v2": (True, True)}
    dim = V.read_version(spark, root, "dim_patients")
    assert dim.count() == spark.read.parquet(f"{SF}/customer.parquet").count()
    # a failed audit later keeps v2 current
    rep3 = run_pipeline(spark, raw, root, "v3", mode="incremental", as_of_date="2024-12-31")
    assert not rep3.first().published and V.current_label(spark, root) == "v2"
    assert {r.label for r in V.list_versions(spark, root).where("current").collect()} == {"v2"}


DIM = [c for c in Q.MART_CHECKS if c.model == "dim_patients"]


def patients(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "patient_id string").withColumn("dbt_updated_at", F.current_timestamp())


def test_label_is_used_once_and_readers_keep_what_was_published(spark, tmp_root):
    good, bad = {"dim_patients": patients(spark, "a")}, {"dim_patients": patients(spark, "b", "b")}
    assert V.write_audit_publish(spark, good, tmp_root, "v1", DIM).first().published
    with pytest.raises(V.LabelTaken):
        V.write_audit_publish(spark, bad, tmp_root, "v1", DIM)
    assert not V.write_audit_publish(spark, bad, tmp_root, "v2", DIM).first().published
    assert [r.patient_id for r in V.read_version(spark, tmp_root, "dim_patients").collect()] == ["a"]
    for label in ("v2", "never-written"):
        with pytest.raises(V.NotPublishable):
            V.publish(spark, tmp_root, label)
    assert V.current_label(spark, tmp_root) == "v1"


def test_audit_without_its_tables_is_an_error(spark):
    with pytest.raises(Q.MissingTable):
        Q.audit({"dim_patients": patients(spark, "a")}, Q.MART_CHECKS)
    with pytest.raises(Q.MissingTable):
        Q.audit({"dim_patients": patients(spark, "a")}, [])


def test_incremental_plus_upsert_equals_full_rebuild(spark):
    full = Build.from_tables(spark, SF)
    first = Build.from_tables(spark, SF, loads=(1,))
    target = first.mart("fct_vitals")
    inc = INC.incremental_filter(full.stg("stg_observations"), target)
    from bundlelake.operators.marts import fct_vitals
    merged = INC.upsert(target, fct_vitals(inc, full.stg("stg_patients")), "observation_id")
    cols = [c for c in merged.columns if c != "dbt_updated_at"]
    assert sorted(merged.select(cols).collect()) == sorted(full.mart("fct_vitals").select(cols).collect())


def test_watermark_equal_not_selected_and_empty_target(spark):
    t = spark.createDataFrame([("a", "2024-01-01 00:00:00")], "k string, s string").selectExpr("k", "cast(s as timestamp) ingested_at")
    src = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("b", "2024-01-02 00:00:00")], "k string, s string") \
        .selectExpr("k", "cast(s as timestamp) ingested_at")
    assert [r.k for r in INC.incremental_filter(src, t).collect()] == ["b"]
    empty = t.limit(0)
    assert INC.incremental_filter(src, empty).count() == 2
    assert INC.incremental_filter(src, empty, empty_target_loads_all=False).count() == 0


def test_command_line_run(spark, tmp_root, capsys):
    from bundlelake.plans.pipeline import main
    raw = os.path.join(tmp_root, "raw")
    files = bundle_files(spark, SF, 1).select(F.col("file_path").alias("path"), F.col("data").alias("body"))
    write_files(files, raw).count()
    root = os.path.join(tmp_root, "lake")
    code = main(["--raw", raw, "--root", root, "--label", "cli1", "--as-of-date", "2024-12-31"])
    out = capsys.readouterr().out
    assert code == 1 and "NOT published" in out and "fct_vitals.patient_id relationships" in out


def test_typed_entries_parse_only_new_landing_rows(spark, tmp_root):
    from bundlelake.operators.entries import bundle_entries
    from bundlelake.operators.staging import stage_typed
    from bundlelake.plans.pipeline import update_typed_entries
    from bundlelake.testing.fixtures import fixture_landing
    land = fixture_landing(spark, SF)
    load1 = land.where("ingestion_timestamp < timestamp'2024-03-01 00:00:00'")
    path = os.path.join(tmp_root, "typed")
    t1 = update_typed_entries(spark, load1, path)
    n1 = t1.count()
    assert n1 == bundle_entries(load1).count()
    t2 = update_typed_entries(spark, land, path)   # only load-2 rows are parsed and appended
    assert t2.count() == bundle_entries(land).count()
    t3 = update_typed_entries(spark, land, path)   # nothing new
    assert t3.count() == t2.count()
    full = Build(spark, land)
    for m in ("stg_patients", "stg_observations"):
        a = stage_typed(t3, m).drop("dbt_processed_at").collect()
        b = full.stg(m).drop("dbt_processed_at").collect()
        assert sorted(a, key=repr) == sorted(b, key=repr)
    # a load stamped before the others, and one under a time that is taken
    late = load1.limit(3).withColumn("ingestion_timestamp", F.lit("2023-01-01 00:00:00").cast("timestamp"))
    same = load1.limit(2).withColumn("file_path", F.concat(F.lit("again/"), F.col("file_path")))
    more = land.unionByName(late).unionByName(same)
    more.write.parquet(os.path.join(tmp_root, "more"))
    more = spark.read.parquet(os.path.join(tmp_root, "more"))
    assert update_typed_entries(spark, more, path).count() == bundle_entries(more).count()


def test_typed_entries_repeat_a_run_that_broke_off(spark, tmp_root):
    from pyspark.sql import DataFrameWriter

    from bundlelake.operators.entries import bundle_entries
    from bundlelake.plans import pipeline as P
    from bundlelake.testing.fixtures import fixture_landing
    land = fixture_landing(spark, SF, loads=(1,)).limit(50)
    land.write.parquet(os.path.join(tmp_root, "land"))
    land, path = spark.read.parquet(os.path.join(tmp_root, "land")), os.path.join(tmp_root, "typed")
    real = DataFrameWriter.parquet

    def crash(self, at, *a, **k):
        if at.endswith("/_loads"):
            raise RuntimeError("lost")
        return real(self, at, *a, **k)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(DataFrameWriter, "parquet", crash)
        with pytest.raises(RuntimeError):
            P.update_typed_entries(spark, land, path)
    assert P.update_typed_entries(spark, land, path).count() == bundle_entries(land).count()
    P.compact_typed_entries(spark, path, path + "-2")
    assert P.update_typed_entries(spark, land, path + "-2").count() == bundle_entries(land).count()


def test_watermark_filter_is_pushed_into_the_scan(spark, tmp_root):
    p = os.path.join(tmp_root, "src")
    spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("b", "2024-01-02 00:00:00")], "k string, s string") \
        .selectExpr("k", "cast(s as timestamp) ingested_at").write.parquet(p)
    src = spark.read.parquet(p)
    t = src.where("k = 'a'")
    out = INC.incremental_filter(src, t)
    assert [r.k for r in out.collect()] == ["b"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ingested_at" in plan
    lazy = INC.incremental_filter(src, t, eager=False)
    assert [r.k for r in lazy.collect()] == ["b"]


def test_stream_typed_mode_matches_batch_mode(spark, tmp_root):
    from bundlelake.plans import versions as VV
    raw = os.path.join(tmp_root, "raw")
    roots = {m: os.path.join(tmp_root, m) for m in ("batch", "stream")}
    for load, label in ((1, "r1"), (2, "r2")):
        files = bundle_files(spark, SF, load).select(F.col("file_path").alias("path"), F.col("data").alias("body"))
        write_files(files, raw).count()
        for mode, root in roots.items():
            run_pipeline(spark, raw, root, label, mode="incremental", as_of_date="2024-12-31",
                         typed_mode=mode, dedup_allergies=True)
    for t in ("stg_observations", "fct_vitals"):
        a = VV.read_version(spark, roots["batch"], t, "r2")
        b = VV.read_version(spark, roots["stream"], t, "r2")
        cols = [c for c in a.columns if c not in ("dbt_processed_at", "dbt_updated_at", "ingested_at",
                                                   "ingestion_timestamp")]
        assert sorted(a.select(cols).collect(), key=repr) == sorted(b.select(cols).collect(), key=repr)


def typed_fixture(spark, tmp_root):
    from bundlelake.testing.build import written_fixture
    return written_fixture(spark, SF, (1,))[1]


def test_a_failed_model_stops_only_what_reads_it(spark, tmp_root):
    from bundlelake.plans.pipeline import build_version
    typed = typed_fixture(spark, tmp_root)
    never = Q.Check("stg_conditions", "accepted_values", "condition_id", ("none of them",))
    checks = [c for c in Q.ALL_CHECKS if not (c.model == "fct_vitals" and c.test == "relationships")] + [never]
    rep = build_version(spark, typed, tmp_root, "v1", "2024-12-31", checks).collect()
    assert len(rep) == len(checks) and not any(r.published for r in rep)
    assert {r.model for r in rep if r.violations} == {"stg_conditions"}
    assert {r.model for r in rep if r.violations is None} == {"fct_conditions"}
    tables = V.list_versions(spark, tmp_root).first().tables
    assert "fct_vitals" in tables and "fct_conditions" not in tables
    # patients are read by every mart
    never = Q.Check("stg_patients", "accepted_values", "patient_id", ("none of them",))
    rep = build_version(spark, typed, tmp_root, "v2", "2024-12-31", [never, *Q.MART_CHECKS]).collect()
    assert sum(r.violations is None for r in rep) == len(Q.MART_CHECKS) and not any(r.published for r in rep)
    with pytest.raises(V.NotPublishable):
        V.publish(spark, tmp_root, "v2")


def test_a_broken_run_is_resumed_under_its_label(spark, tmp_root):
    first, second = {"dim_patients": patients(spark, "a")}, {"dim_patients": patients(spark, "b", "c")}
    assert not V.claim_label(spark, tmp_root, "v1")
    V.write_tables(first, tmp_root, "v1")
    V.audit_step(spark, tmp_root, "v1", first, DIM[:1], final=False)
    with pytest.raises(V.LabelTaken):
        V.write_audit_publish(spark, second, tmp_root, "v1", DIM)
    rep = V.write_audit_publish(spark, second, tmp_root, "v1", DIM, resume=True)
    assert rep.count() == len(DIM) and rep.first().published
    assert sorted(r.patient_id for r in V.read_version(spark, tmp_root, "dim_patients").collect()) == ["b", "c"]
    with pytest.raises(V.LabelTaken):
        V.write_audit_publish(spark, first, tmp_root, "v1", DIM, resume=True)


def test_a_part_of_the_loads_is_not_built_again(spark, monkeypatch):
    from bundlelake.testing import build as B
    built = []
    write = B.write_landing_and_typed
    monkeypatch.setattr(B, "_WRITTEN", {})
    monkeypatch.setattr(B, "write_landing_and_typed", lambda *a: built.append(1) or write(*a))
    found = {loads: B.written_fixture(spark, SF, loads) for loads in ((1,), (1, 2), (2,))}
    assert len(built) == 1
    for loads, (landing, typed) in found.items():
        want = fixture_landing(spark, SF, loads=loads)
        assert sorted(map(tuple, landing.collect())) == sorted(map(tuple, want.collect()))
        assert typed.count() == B.model_types(B.bundle_entries(want)).count()


def test_dedup_latest_parses_the_bundles_once(spark):
    from bundlelake.testing.registry import QUERIES
    out = QUERIES["dedup_latest"](spark, SF)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "parse_json" not in plan and "parseJson" not in plan and "variant_get" not in plan
    assert out.where("n_copies = 2").count() > 0


def fresh_build(monkeypatch):
    """The module of fixture builds, with nothing written yet; lists the models of every extraction."""
    from bundlelake.testing import build as B
    passes, extract = [], B.typed_entries
    monkeypatch.setattr(B, "_WRITTEN", {})
    monkeypatch.setattr(B, "typed_entries", lambda entries, on_malformed="fail", models=tuple(STAGING_SPECS): (
        passes.append(set(models)) or extract(entries, on_malformed, models)))
    return B, passes


def plain_rows(df):
    return sorted(df.drop("dbt_processed_at", "dbt_updated_at").collect(), key=repr)


def test_models_asked_for_are_extracted_in_one_pass(spark, monkeypatch):
    whole = {m: plain_rows(df) for m, df in Build.from_tables(spark, SF).layers().items()}
    B, passes = fresh_build(monkeypatch)
    build = B.Build.from_tables(spark, SF)
    assert plain_rows(build.stg("stg_encounters")) == whole["stg_encounters"]
    assert passes == [{"stg_encounters"}]
    assert plain_rows(build.mart("fct_conditions")) == whole["fct_conditions"]
    assert passes[1:] == [{"stg_conditions", "stg_patients"}]
    again = B.Build.from_tables(spark, SF)
    assert plain_rows(again.mart("fct_encounters")) == whole["fct_encounters"] and len(passes) == 2
    assert again.typed.count() == B.written_fixture(spark, SF)[1].count() and passes[2:] == [set(STAGING_SPECS)]


def test_a_model_without_entries_is_empty(spark, tmp_path, monkeypatch):
    B, _ = fresh_build(monkeypatch)
    for t in ("customer", "nation", "region", "orders", "events"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(50).write.parquet(f"{tmp_path}/{t}.parquet")
    spark.read.parquet(f"{SF}/lineitem.parquet").limit(0).write.parquet(f"{tmp_path}/lineitem.parquet")
    build = B.Build.from_tables(spark, str(tmp_path))
    assert build.mart("fct_medications").count() == 0 and build.stg("stg_medication_requests").count() == 0
    assert build.stg("stg_encounters").count() == 50


def test_a_version_of_one_table_writes_no_other_layers(spark, monkeypatch):
    B, passes = fresh_build(monkeypatch)
    build = B.Build.from_tables(spark, SF)
    dim = build.layers("dim_patients")
    assert list(dim) == ["dim_patients"] and passes == [{"stg_patients", "stg_encounters"}]
    there, = (v for k, v in B._WRITTEN.items() if k[0] == "layers")
    assert set(there) == {"stg_patients", "stg_encounters", "dim_patients"}
    assert plain_rows(build.layers()["dim_patients"]) == plain_rows(dim["dim_patients"]) and set(there) == {*STAGING_SPECS, *M.MART_KEYS}


def test_bundles_parsed_by_a_query_are_not_extracted_before(spark, monkeypatch):
    from bundlelake.testing.registry import QUERIES
    _, passes = fresh_build(monkeypatch)
    assert QUERIES["reference_strip"](spark, SF).count() > 0 and not passes


def test_race_share_reads_the_dimension_once(spark):
    from bundlelake.operators import serving as S
    dim = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "race string").repartition(2)
    out = S.race_distribution(dim)
    assert [tuple(r) for r in out.collect()] == [("a", 2, 0.5), ("b", 1, 0.25), (None, 1, 0.25)]
    assert "subquery" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_a_version_is_built_under_its_label_and_marts_read_what_was_written(spark, tmp_root, monkeypatch):
    V.claim_label(spark, tmp_root, "v1")
    read = []

    def mart(written):
        read.append(written["s"].inputFiles()[0])
        return written["s"].where("x > 0")

    out = V.write_tables({"m": mart, "s": spark.createDataFrame([(0,), (1,)], "x int")}, tmp_root, "v1")
    assert list(out) == ["m", "s"] and [r.x for r in out["m"].collect()] == [1]
    assert "/versions/v1/s/" in read[0]
    # the queries write no second copy of their tables
    monkeypatch.setattr(Build, "layers", lambda *a: pytest.fail("written twice"))
    assert registry.QUERIES["wap_publish"](spark, SF).where("violations > 0").count() == 2
    assert registry.QUERIES["wap_publish_clean"](spark, SF).where("published").count() == 61


def test_bundles_of_several_loads_come_from_one_scan(spark):
    both, apart = bundle_files(spark, SF, 1, 2), bundle_files(spark, SF, 1).unionByName(bundle_files(spark, SF, 2))
    assert both.exceptAll(apart).isEmpty() and apart.exceptAll(both).isEmpty()
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet [l_orderkey")
    assert scans(both) == 1 and scans(apart) == 2
