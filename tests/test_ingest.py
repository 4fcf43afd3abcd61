"""File-based ingestion: listing, filters, ledger, refresh, streaming."""

import os
from zipfile import ZipFile

from pyspark.sql import functions as F

from bundlelake.sources import landing as L
from bundlelake.streaming.ingest import run_available_now
from bundlelake.testing import registry
from bundlelake.testing.files import write_archives
from bundlelake.testing.fixtures import bundle_files


def put(root, rel, data: bytes):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "wb") as f:
        f.write(data)


def manifest(spark, raw):
    return L.relative_paths(L.list_raw_files(spark, raw), raw, "raw/")


def test_listing_filters_and_size_boundary(spark, tmp_root):
    raw = os.path.join(tmp_root, "raw")
    put(raw, "a.json", b'{"entry":[]}')
    put(raw, "sub/b.json", b'{"entry":[]}')
    put(raw, "c.txt", b"x")
    put(raw, "d.JSON", b"{}")
    m = manifest(spark, raw)
    assert sorted(r.path for r in L.json_keys(m).collect()) == ["raw/a.json", "raw/sub/b.json"]
    sized = spark.createDataFrame([("k1.json", 3 * 1024 * 1024), ("k2.json", 3 * 1024 * 1024 + 1)], "path string, length long")
    assert [r.path for r in L.size_guard(sized, L.MAX_FILE_BYTES).collect()] == ["k1.json"]


def test_size_filter_pushed_into_scan(spark, tmp_root):
    raw = os.path.join(tmp_root, "raw")
    put(raw, "a.json", b"{}")
    plan = L.size_guard(L.list_raw_files(spark, raw), 10)._jdf.queryExecution().executedPlan().toString()
    assert "length" in plan and "LessThanOrEqual" in plan


def test_incremental_ledger_cap_and_invalid_utf8(spark, tmp_root):
    raw = os.path.join(tmp_root, "raw")
    for i in range(5):
        put(raw, f"f{i}.json", ('{"entry":[],"i":%d}' % i).encode())
    put(raw, "bad.json", b"\xff\x41")
    lp = os.path.join(tmp_root, "landing")
    m = manifest(spark, raw)
    # bad.json is first by path; once on record it no longer comes before others
    assert L.ingest_incremental(spark, m, lp, max_files=3) == 2
    assert L.ingest_incremental(spark, m, lp, max_files=3) == 3
    assert L.ingest_incremental(spark, m, lp, max_files=3) == 0
    assert [(r.file_path, r.reason) for r in L.read_skipped(spark, lp).collect()] == [("raw/bad.json", "not UTF-8")]
    rej = L.decode_rejects(L.pending(m, L.read_landing(spark, lp)))
    assert [r.file_path for r in rej.collect()] == ["raw/bad.json"]
    # same path, new content: not re-read
    put(raw, "f0.json", b'{"changed":true}')
    assert L.ingest_incremental(spark, manifest(spark, raw), lp) == 0
    assert L.read_landing(spark, lp).where(F.col("data").contains("changed")).count() == 0


def test_one_timestamp_per_run(spark, tmp_root):
    raw = os.path.join(tmp_root, "raw")
    for i in range(4):
        put(raw, f"f{i}.json", b"{}")
    lp = os.path.join(tmp_root, "landing")
    L.ingest_incremental(spark, manifest(spark, raw), lp)
    assert L.read_landing(spark, lp).select("ingestion_timestamp").distinct().count() == 1


def test_full_refresh_replaces_and_skips_when_empty(spark, tmp_root):
    raw = os.path.join(tmp_root, "raw")
    put(raw, "a.json", b"{}")
    lp = os.path.join(tmp_root, "landing")
    assert L.ingest_full_refresh(spark, manifest(spark, raw), lp)
    assert L.ingest_full_refresh(spark, manifest(spark, raw), lp)
    assert L.read_landing(spark, lp).count() == 1
    empty = os.path.join(tmp_root, "empty")
    os.makedirs(empty)
    put(empty, "only.txt", b"x")
    assert not L.ingest_full_refresh(spark, manifest(spark, empty), lp)
    assert L.read_landing(spark, lp).count() == 1


def test_absent_landing_reads_empty(spark, tmp_root):
    assert L.read_landing(spark, os.path.join(tmp_root, "nope")).count() == 0


def test_stream_available_now_twice(spark, tmp_root):
    raw = os.path.join(tmp_root, "raw")
    for i in range(7):
        put(raw, f"s{i}.json", b'{"entry":[]}')
    put(raw, "skip.txt", b"x")
    lp, ck = os.path.join(tmp_root, "landing"), os.path.join(tmp_root, "ckpt")
    r1 = run_available_now(spark, raw, lp, ck, max_files_per_trigger=3)
    assert r1["rows"] == 7 and r1["batches"] == 3
    put(raw, "s0.json", b'{"entry":[1]}')  # changed under a known name: not re-read
    put(raw, "new.json", b"{}")
    r2 = run_available_now(spark, raw, lp, ck, max_files_per_trigger=3)
    assert r2["rows"] == 1
    assert L.read_landing(spark, lp).count() == 8


def test_cap_reads_only_chosen_bodies(spark, tmp_root):
    raw = os.path.join(tmp_root, "raw")
    for i in range(6):
        put(raw, f"c{i}.json", b"{}")
    m = manifest(spark, raw)
    batch = L.incremental_batch(m, L.read_landing(spark, os.path.join(tmp_root, "none")), max_files=2)
    assert sorted(r.file_path for r in batch.collect()) == ["raw/c0.json", "raw/c1.json"]
    assert len(batch.inputFiles()) == 2  # the other bodies are not opened


def test_no_limits_unless_asked_for(spark, tmp_root):
    raw, lp = os.path.join(tmp_root, "raw"), os.path.join(tmp_root, "landing")
    put(raw, "large.json", b"x" * (L.MAX_FILE_BYTES + 1))
    for i in range(L.MAX_FILES_PER_RUN + 5):
        put(raw, f"n{i}.json", b"{}")
    assert L.ingest_incremental(spark, manifest(spark, raw), lp) == L.MAX_FILES_PER_RUN + 6


def test_stream_lands_old_files_and_repaired_ones(spark, tmp_root):
    raw, lp, ck = (os.path.join(tmp_root, x) for x in ("raw", "landing", "ckpt"))
    put(raw, "a.json", b"{}")
    put(raw, "bad.json", b"\xff")
    assert run_available_now(spark, raw, lp, ck)["rows"] == 1
    put(raw, "late.json", b"{}")  # modified a month before the newest file seen
    old = os.path.getmtime(os.path.join(raw, "a.json")) - 30 * 86400
    os.utime(os.path.join(raw, "late.json"), (old, old))
    put(raw, "bad.json", b"{}")
    out = run_available_now(spark, raw, lp, ck)
    assert out["rows"] == 2 and out["retried"] == 1
    assert sorted(r.file_path for r in L.read_landing(spark, lp).collect()) == ["a.json", "bad.json", "late.json"]


def test_failed_refresh_leaves_the_old_generation(spark, tmp_root, monkeypatch):
    raw, lp = os.path.join(tmp_root, "raw"), os.path.join(tmp_root, "landing")
    put(raw, "a.json", b"{}")
    assert L.ingest_full_refresh(spark, manifest(spark, raw), lp)
    put(raw, "b.json", b"{}")

    def crash(*a, **k):
        raise RuntimeError("lost")

    monkeypatch.setattr(L, "record_skipped", crash)  # after the rows, before the switch
    try:
        L.ingest_full_refresh(spark, manifest(spark, raw), lp)
    except RuntimeError:
        pass
    assert L.read_landing(spark, lp).count() == 1


def test_bodies_are_opened_once_and_only_from_the_oldest_pending_file_on(spark, tmp_root):
    raw, lp = os.path.join(tmp_root, "raw"), os.path.join(tmp_root, "landing")
    for i in range(6):
        put(raw, f"n{i}.json", b'{"n":1}')
        os.utime(os.path.join(raw, f"n{i}.json"), (1_700_000_000 + i, 1_700_000_000 + i))
    m = manifest(spark, raw)
    run = L.outcomes(L.bodies(m, L.to_land(m, L.read_landing(spark, lp), L.read_skipped(spark, lp))), "2024-01-01 00:00:00")
    plan = run._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan binaryFile" in x]
    assert sum("content" in x.split("Batched")[0] for x in scans) == 1
    assert L.ingest_incremental(spark, m, lp) == 6

    for name in ("late.json", "bad.json"):
        put(raw, name, b"\xff" if name == "bad.json" else b"{}")
        os.utime(os.path.join(raw, name), (1_800_000_000, 1_800_000_000))
    m = manifest(spark, raw)
    todo = L.to_land(m, L.read_landing(spark, lp), L.read_skipped(spark, lp))
    assert sorted(r.path for r in todo.collect()) == ["raw/bad.json", "raw/late.json"]
    plan = L.bodies(m, todo)._jdf.queryExecution().executedPlan().toString()
    assert any("GreaterThanOrEqual(modificationTime" in x and "content" in x for x in plan.splitlines() if "FileScan binaryFile" in x)
    # the filter alone, without the join, leaves the old files closed
    oldest = todo.agg(F.min("modificationTime").alias("t")).first()["t"]
    assert m.where(F.col("modificationTime") >= F.lit(oldest)).count() == 2
    assert L.ingest_incremental(spark, m, lp) == 1
    # rejected and unchanged: not opened again; changed: tried again
    assert L.to_land(m, L.read_landing(spark, lp), L.read_skipped(spark, lp)).isEmpty()
    assert L.ingest_incremental(spark, m, lp) == 0
    put(raw, "bad.json", b"{}")
    assert L.ingest_incremental(spark, manifest(spark, raw), lp) == 1
    assert L.read_landing(spark, lp).count() == 8 and L.read_skipped(spark, lp).count() == 1


def test_every_file_has_one_outcome(spark, tmp_root):
    rows = [("a.json", 2, b"{}"), ("b.json", 2, b"\xff\xfe"), ("c.json", 0, None), ("d.json", 9, b"123456789"), ("e.txt", 1, b"x")]
    m = spark.createDataFrame(rows, "path string, length long, content binary")
    lp = os.path.join(tmp_root, "landing")
    assert L.ingest_incremental(spark, m, lp, max_bytes=8) == 1
    assert {(r.file_path, r.reason) for r in L.read_skipped(spark, lp).collect()} == {
        ("b.json", "not UTF-8"), ("c.json", "no content"), ("d.json", "too large")}
    assert L.ingest_incremental(spark, m, lp, max_bytes=8) == 0
    assert L.read_skipped(spark, lp).count() == 3
    assert L.ingest_incremental(spark, m, lp) == 1  # the limit is gone
    assert sorted(r.file_path for r in L.read_landing(spark, lp).collect()) == ["a.json", "d.json"]


def test_unchanged_rejects_are_left_alone_by_the_stream(spark, tmp_root):
    from bundlelake.streaming.ingest import due_again
    raw, lp, ck = (os.path.join(tmp_root, x) for x in ("raw", "landing", "ckpt"))
    for i in range(40):
        put(raw, f"bad{i}.json", b"\xff%d" % i)
    assert run_available_now(spark, raw, lp, ck) == {"batches": 1, "rows": 0, "retried": 0}
    put(raw, "bad7.json", b"{}")
    listed = L.relative_paths(L.list_raw_files(spark, raw), raw).drop("content")
    due = due_again(listed, L.read_skipped(spark, lp), L.read_landing(spark, lp))
    assert [r.path for r in due.collect()] == ["bad7.json"]
    assert run_available_now(spark, raw, lp, ck)["retried"] == 1
    assert run_available_now(spark, raw, lp, ck)["retried"] == 0


def test_refresh_that_lands_nothing_records_why(spark, tmp_root):
    bad = spark.createDataFrame([("a.json", 2, b"\xff\xfe")], "path string, length long, content binary")
    at = os.path.join(tmp_root, "landing")
    assert not L.ingest_full_refresh(spark, bad, at)
    assert [(r.file_path, r.reason) for r in L.read_skipped(spark, at).collect()] == [("a.json", "not UTF-8")]
    assert L.read_landing(spark, at).count() == 0


def test_stream_mode_keeps_quarantine_and_stands_an_empty_landing(spark, tmp_root):
    from bundlelake.plans.pipeline import read_quarantine
    from bundlelake.streaming.typed import read_typed_stream, run_typed_available_now
    landing, typed, ckpt = (os.path.join(tmp_root, x) for x in ("landing", "typed/data", "ckpt"))
    assert read_typed_stream(spark, typed).count() == 0
    rows = [("p", '{"entry":[{"resource":{"resourceType":"Patient","id":"1","birthDate":"never"}}]}'), ("q", '{"entry":'), ("r", '{"entry":5}')]
    L.append_landing(L.stamp(spark.createDataFrame(rows, "file_path string, data string"), "2024-01-01 00:00:00"), landing)
    run_typed_available_now(spark, landing, typed, ckpt, on_malformed="quarantine")
    assert [r.stg_patients.patient_id for r in read_typed_stream(spark, typed).collect()] == ["1"]
    kept = {(r.file_path, r.reason, r.column, r.text) for r in read_quarantine(spark, os.path.join(tmp_root, "typed")).collect()}
    assert kept == {("p", "bad value", "birth_date", "never"), ("q", "not JSON", None, None), ("r", "entry is not an array", None, None)}


def test_listing_by_tasks_is_spark_s_listing_and_bodies_are_opened_by_name(spark, tmp_root):
    raw, lp, ck = (os.path.join(tmp_root, x) for x in ("raw files", "landing", "ckpt"))
    for name in ("a.json", "sub/b.json", "sub/deep/c.json", "_hidden.json", ".x.json", "_dir/d.json", "k=1/e.json", "sub/n.txt", "sub/é %.json"):
        put(raw, name, name.encode())
    os.makedirs(os.path.join(raw, "empty"))
    listed, of_spark = L.list_files(spark, raw), L.list_raw_files(spark, raw).drop("content")
    assert listed.columns == of_spark.columns
    assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, of_spark.collect())) and listed.count() == 5
    # the driver's plans hold the listing's files, not the raw ones
    m = L.relative_paths(listed, raw)
    assert not any("raw" in f for f in m.inputFiles())
    assert L.ingest_incremental(spark, m, lp, max_files=2) == 2
    assert L.ingest_incremental(spark, m, lp) == 3
    assert {r.file_path: r.data for r in L.read_landing(spark, lp).collect()} == {
        n: n for n in ("a.json", "sub/b.json", "sub/deep/c.json", "k=1/e.json", "sub/é %.json")}
    assert run_available_now(spark, raw, lp, ck) == {"batches": 1, "rows": 0, "retried": 0}
    log = os.listdir(os.path.join(ck, "sources", "0"))
    assert log and not any("a.json" in open(os.path.join(ck, "sources", "0", x)).read() for x in log if not x.startswith("."))


def test_members_of_archives_are_files_of_the_folder(spark, tmp_root):
    raw, lp = os.path.join(tmp_root, "raw!"), os.path.join(tmp_root, "landing")
    bodies = {"p/a.json": "A", "p/é %!.json": "E", "b.json": "B", "p/_dir/x.json": "x", ".y.json": "y", "n.txt": "n"}
    files = spark.createDataFrame(list(bodies.items()), "path string, body string")
    assert write_archives(files, raw).count() == 6
    put(raw, "sub/c.json", b"C")
    assert sum(len(f) for _, _, f in os.walk(raw)) < 6
    m = lambda: L.relative_paths(L.list_files(spark, raw, archives="*.zip"), raw)
    assert {r.path: r.length for r in m().collect()} == dict.fromkeys(("p/a.json", "p/é %!.json", "b.json", "sub/c.json"), 1)
    assert L.list_files(spark, raw).count() == 1  # archives are read where asked for
    assert L.ingest_incremental(spark, m(), lp, max_files=2) == 2
    assert L.ingest_incremental(spark, m(), lp) == 2
    # sent again in a later archive: a known path is not read again, a full refresh takes what came last
    write_archives(spark.createDataFrame([("p/a.json", "A2"), ("d.json", "D")], "path string, body string").coalesce(1), raw).count()
    for name in os.listdir(raw):
        if name.endswith(".zip") and "d.json" not in ZipFile(os.path.join(raw, name)).namelist():
            os.utime(os.path.join(raw, name), (1.7e9, 1.7e9))
    assert m().count() == 5 and L.ingest_incremental(spark, m(), lp) == 1
    want = {"p/a.json": "A", "p/é %!.json": "E", "b.json": "B", "sub/c.json": "C", "d.json": "D"}
    assert {r.file_path: r.data for r in L.read_landing(spark, lp).collect()} == want
    assert L.ingest_full_refresh(spark, m(), lp)
    assert {r.file_path: r.data for r in L.read_landing(spark, lp).collect()} == want | {"p/a.json": "A2"}


def test_scheduled_runs_do_not_take_a_file_of_the_disk_per_bundle(spark, monkeypatch):
    """15 million files of a block each do not fit a disk that holds their text many times."""
    seen = {}

    def ingest(spark, raw, root, label, archives=None, **_):
        listed = L.relative_paths(L.list_files(spark, raw, archives=archives), raw)
        assert listed.count() == listed.select("path").distinct().count()
        seen[label] = listed.count(), sum(len(f) for _, _, f in os.walk(raw))
        return listed

    monkeypatch.setattr(registry, "run_pipeline", ingest)
    sf = "/root/testdata/sf0.001"
    rows = registry.QUERIES["pipeline_run"](spark, sf).select("path").collect()
    assert {r.path for r in rows} == {r.file_path for load in (1, 2) for r in bundle_files(spark, sf, load).select("file_path").collect()}
    assert all(10 * stored < files for files, stored in seen.values())
