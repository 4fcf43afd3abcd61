"""Benchmark: the full bundle pipeline at $BENCH_SF_DIR on local[$BENCH_CPUS].

Stages timed separately (each writes its output, as a scheduled job does):
landing (bundles derived from the tables), entries (parse + explode once),
the 8 staging models, the 7 marts, the 61-test audit, and the dashboard
queries over the written marts.  Beside them: ingestion of real files, and
whole hourly runs.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bundlelake.operators import marts as M  # noqa: E402
from bundlelake.operators import quality as Q  # noqa: E402
from bundlelake.operators import serving as S  # noqa: E402
from bundlelake.operators.entries import bundle_entries  # noqa: E402
from bundlelake.operators.staging import model_types, stage, stage_typed, typed_entries  # noqa: E402
from bundlelake.schemas import STAGING_SPECS  # noqa: E402
from bundlelake.session import build_session, scratch_path  # noqa: E402
from bundlelake.sources import landing as L  # noqa: E402
from bundlelake.plans.pipeline import build_version, update_typed_entries  # noqa: E402
from bundlelake.testing.files import write_files  # noqa: E402
from bundlelake.testing.fixtures import AS_OF_DATE, fixture_landing  # noqa: E402
from bundlelake.testing.manifests import document_objects  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")}
    spark = build_session(f"local[{cpus}]", app="bundlelake-bench", shuffle_partitions=int(cpus) * 2, extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_path(spark, "bench")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        out = fn()
        times[name] = round(time.time() - t0, 3)
        return out

    def write(df, path, part=None):
        w = df.write.mode("overwrite")
        if part:
            w = w.partitionBy(part)
        w.parquet(path)

    timed("landing", lambda: write(fixture_landing(spark, sf_dir), f"{root}/landing"))
    landing = spark.read.parquet(f"{root}/landing")
    timed("typed_entries", lambda: write(typed_entries(model_types(bundle_entries(landing))), f"{root}/typed", "resource_type"))
    typed = spark.read.parquet(f"{root}/typed")
    stg = {}
    for m in STAGING_SPECS:
        timed(m, lambda m=m: write(stage_typed(typed, m), f"{root}/{m}"))
        stg[m] = spark.read.parquet(f"{root}/{m}")
    marts = {}
    builders = {"dim_patients": lambda: M.dim_patients(stg["stg_patients"], stg["stg_encounters"], AS_OF_DATE)}
    for name, (fn, src) in M.FACTS.items():
        builders[name] = (lambda fn=fn, src=src: fn(stg[src], stg["stg_patients"]))
    for name, b in builders.items():
        timed(name, lambda name=name, b=b: write(b(), f"{root}/{name}"))
        marts[name] = spark.read.parquet(f"{root}/{name}")
    timed("dq_report", lambda: Q.audit({**stg, **marts}).collect())
    serving = {
        "demographics": lambda: S.demographics(marts["dim_patients"]).count(),
        "top_conditions": lambda: S.top_conditions(marts["fct_conditions"]).collect(),
        "top_medications": lambda: S.top_medications(marts["fct_medications"]).collect(),
        "encounter_trends": lambda: S.encounter_trends(marts["fct_encounters"]).collect(),
        "vitals_summary": lambda: S.vitals_summary(marts["fct_vitals"]).collect(),
        "kpis": lambda: S.kpis(marts["dim_patients"], marts["fct_conditions"], marts["fct_medications"],
                               marts["fct_encounters"]).collect(),
    }
    for name, fn in serving.items():
        timed(name, fn)
    total_of = dict(times)
    # ingestion of real files: one file per document, a first run and one that finds nothing new
    docs = f"{root}/raw-docs"
    write_files(document_objects(spark, sf_dir), docs).count()
    manifest = lambda: L.relative_paths(L.list_raw_files(spark, docs), docs)
    timed("ingest_files", lambda: L.ingest_incremental(spark, manifest(), f"{root}/doc-landing"))
    timed("ingest_files_again", lambda: L.ingest_incremental(spark, manifest(), f"{root}/doc-landing"))
    # the next hourly run, whole: a new batch (the re-sent bundles again, stamped later) is parsed into the shared
    # typed table, then every staging model, mart and test, with full and with incremental marts
    lake = f"{root}/lake"
    first = update_typed_entries(spark, landing, f"{lake}/typed")
    checks = [c for c in Q.ALL_CHECKS if c.test != "relationships"]  # the fixtures have dangling subjects
    timed("hourly_first_build_of_state", lambda: build_version(spark, first, lake, "v0", AS_OF_DATE, checks, dedup_allergies=True, marts="incremental"))
    new_batch = landing.where(F.col("file_path").startswith("raw/fhir/resend/")).withColumn(
        "ingestion_timestamp", F.lit("2024-04-01 00:00:00").cast("timestamp"))
    landing_next = landing.unionByName(new_batch)
    typed_next = timed("hourly_parse_new_batch", lambda: update_typed_entries(spark, landing_next, f"{lake}/typed"))
    for m in ("full", "incremental"):  # the first anew, the second on top of v0
        timed(f"hourly_build_{m}_marts", lambda m=m: build_version(
            spark, typed_next, lake, f"v-{m}", AS_OF_DATE, checks, dedup_allergies=True, marts=m))
    total = round(sum(total_of.values()), 3)  # the stages above; the runs below them are counted apart
    result = {"metric": "bundle_pipeline_total", "value": total, "unit": "sec",
              "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
              "cpus": int(cpus)}
    if os.environ.get("BENCH_REFERENCE_SHAPE") == "1":
        # the reference's shape: every staging model parses the landing again
        ref = {}
        for m in STAGING_SPECS:
            t0 = time.time()
            write(stage(bundle_entries(landing), m), f"{root}/reparse_{m}")
            ref[m] = round(time.time() - t0, 3)
        result["reference_shape_staging"] = ref
        result["reference_shape_staging_total"] = round(sum(ref.values()), 3)
        result["shared_parse_staging_total"] = round(times["typed_entries"] + sum(times[m] for m in STAGING_SPECS), 3)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
