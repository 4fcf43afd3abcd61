"""Aggregates that can be taken back, dashboard rollups, and what can go."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from bundlelake.operators import marts as M
from bundlelake.operators import partials as P
from bundlelake.operators import serving as S
from bundlelake.plans import current as C
from bundlelake.plans import retention
from bundlelake.plans import rollups as R
from bundlelake.plans import versions as V
from bundlelake.plans.pipeline import compact_typed_entries, read_quarantine, update_typed_entries
from bundlelake.sources import landing as L
from bundlelake.testing.build import Build

SF, AS_OF = "/root/testdata/sf0.001", "2024-12-31"
MARCH = "timestamp'2024-02-15 00:00:00'"
VISITS = "encounter_id string, patient_id string, start_time date"


def test_counted_days_equal_a_rebuild_after_any_changes(spark):
    rng = random.Random(7)
    day = lambda: None if rng.random() < 0.1 else dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(20))
    who = lambda: None if rng.random() < 0.05 else f"p{rng.randrange(6)}"
    now = {f"e{i}": (who(), day()) for i in range(120)}
    frame = lambda d: spark.createDataFrame([(k, *v) for k, v in sorted(d.items())], VISITS)
    days = P.visit_days(None, frame(now))
    for _ in range(4):
        touched = rng.sample(sorted(now), 40)
        was = {k: now[k] for k in touched}
        for k in touched:
            now.pop(k)
        became = {k: (who(), day()) for k in touched if rng.random() < 0.6} | {f"n{rng.random()}": (who(), day()) for _ in range(5)}
        now |= became
        days = days.unionByName(P.visit_days(frame(was), frame(became)))
    got = {tuple(r) for r in P.patient_stats(days).collect()}
    assert got == {tuple(r) for r in M.patient_encounter_stats(frame(now)).collect()}
    gone = P.patient_stats(days.unionByName(P.visit_days(frame(now), frame({}))))
    assert gone.isEmpty()


def test_what_stays_as_it_is_adds_no_state(spark):
    a = spark.createDataFrame([("x", 0.1), ("x", None), ("y", 2.5)], "g string, v double")
    assert P.signed(a, a, {"g": F.col("g")}, F.col("v")).isEmpty()
    b = spark.createDataFrame([("x", 0.3), ("x", None), ("y", 2.5)], "g string, v double")
    assert [(r.g, r.n, float(r.total)) for r in P.signed(a, b, {"g": F.col("g")}, F.col("v")).collect()] == [("x", 0, 0.2)]


def panels(spark, root):
    p = {m: R.panel(spark, root, m) for m in R.PANELS}
    return {"c": R.top(p["fct_conditions"], "condition_description", 1000), "m": R.top(p["fct_medications"], "medication_description", 1000),
            "t": R.encounter_trends(p["fct_encounters"]), "v": R.vitals_summary(p["fct_vitals"], 0)}


def plain(marts):
    return {"c": S.top_conditions(marts("fct_conditions"), 1000), "m": S.top_medications(marts("fct_medications"), 1000),
            "t": S.encounter_trends(marts("fct_encounters")), "v": S.vitals_summary(marts("fct_vitals"), 0)}


def listed(df):
    return [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()]


def test_rollups_follow_the_state(spark, tmp_root, monkeypatch):
    typed = Build.from_tables(spark, SF).typed
    with pytest.raises(LookupError):
        R.update(spark, tmp_root)
    C.apply(spark, tmp_root, typed.where(f"ingestion_timestamp < {MARCH}"), [("1", 1)], AS_OF, buckets=2)
    assert R.update(spark, tmp_root) == 1 and R.update(spark, tmp_root) == 1
    state = C.apply(spark, tmp_root, typed.where(f"ingestion_timestamp > {MARCH}"), [("2", 1)], AS_OF)
    with pytest.raises(LookupError):  # not up to date: an error, no stale figures
        R.panel(spark, tmp_root, "fct_vitals")
    assert R.update(spark, tmp_root) == 2
    want = plain(Build.from_tables(spark, SF).mart)
    for name, df in panels(spark, tmp_root).items():
        assert listed(df) == listed(want[name]), name
    # the generation before is read as it was; the second update holds changed groups only
    old = R.top(R.panel(spark, tmp_root, "fct_conditions", 1), "condition_description", 1000)
    assert listed(old) == listed(S.top_conditions(Build.from_tables(spark, SF, loads=(1,)).mart("fct_conditions"), 1000))
    second = spark.read.parquet(f"{tmp_root}/state/{state.era}/rollups/2")
    assert second.where("panel = 'fct_conditions'").isEmpty()  # sent again with the same descriptions
    assert not second.where("panel = 'fct_vitals' and n = 0 and total <> 0").isEmpty()  # sent again with other values
    C.compact(spark, tmp_root)
    assert R.update(spark, tmp_root) == 3
    for name, df in panels(spark, tmp_root).items():
        assert listed(df) == listed(want[name]), name


def test_compaction_keeps_the_quarantine(spark, tmp_root):
    old, new = os.path.join(tmp_root, "typed"), os.path.join(tmp_root, "compact")
    rows = [("p", '{"entry":[{"resource":{"resourceType":"Patient","id":"1","birthDate":"never"}}]}'), ("q", '{"entry":')]
    landing = L.stamp(spark.createDataFrame(rows, "file_path string, data string"), "2024-01-01 00:00:00")
    typed = update_typed_entries(spark, landing, old, "quarantine").count()
    compact_typed_entries(spark, old, new)
    assert update_typed_entries(spark, landing, new, "quarantine").count() == typed == 1
    kept = lambda at: sorted(tuple(r) for r in read_quarantine(spark, at).select("file_path", "reason").collect())
    assert kept(new) == kept(old) == [("p", "bad value"), ("q", "not JSON")]


def test_sweep_takes_what_nobody_reads(spark, tmp_root):
    df = spark.range(3)
    ok = spark.createDataFrame([("t", "unique", "id", 0)], "model string, test string, column string, violations long")
    for label, violations, final in (("v1", 0, True), ("v2", 4, True), ("v3", 0, True), ("v4", 0, False), ("v5", 0, True), ("v6", 0, True)):
        V.claim_label(spark, tmp_root, label)
        V.write_tables({"t": df}, tmp_root, label)
        V.keep_report(spark, tmp_root, label, ok.withColumn("violations", F.lit(violations).cast("long")), final)
        if label in ("v1", "v3", "v6"):
            V.publish(spark, tmp_root, label)
    m = spark.createDataFrame([("a.json", 2, b"{}")], "path string, length long, content binary")
    for _ in range(2):
        L.ingest_full_refresh(spark, m, f"{tmp_root}/landing")
    found = retention.sweep(spark, tmp_root).collect()
    versions = {(r.name, r.reason) for r in found if r.kind == "version"}
    assert versions == {("v1", "replaced"), ("v2", "failed its audit")}  # v3 is kept beside v6, v4 can be resumed, v5 promoted
    assert len([r for r in found if r.kind == "landing"]) == 1
    assert all(os.path.isdir(r.path) for r in found)  # a dry run
    retention.sweep(spark, tmp_root, dry_run=False)
    assert not any(os.path.isdir(r.path) for r in found)
    assert retention.unreachable(spark, tmp_root).isEmpty()
    assert V.read_version(spark, tmp_root, "t").count() == V.read_version(spark, tmp_root, "t", "v4").count() == 3
    assert L.read_landing(spark, f"{tmp_root}/landing").count() == 1
    with pytest.raises(V.LabelTaken):
        V.claim_label(spark, tmp_root, "v1", resume=True)


def test_rollups_of_a_state_of_one_mart(spark, tmp_root):
    build = Build.from_tables(spark, SF)
    typed = build.typed_for("fct_medications")
    for cond in ("<", ">"):
        state = C.apply(spark, tmp_root, typed.where(f"ingestion_timestamp {cond} {MARCH}"), buckets=2, marts=["fct_medications"])
        R.update(spark, tmp_root)
    got = R.top(R.panel(spark, tmp_root, "fct_medications"), "medication_description", 1000).collect()
    assert got == S.top_medications(build.mart("fct_medications"), 1000).collect() and state.marts == ["fct_medications"]
    with pytest.raises(LookupError):
        R.panel(spark, tmp_root, "fct_conditions")
