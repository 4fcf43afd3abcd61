"""Named queries (one per operator of the survey) and their SQL oracles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlelake.functions.json import json_scalar, strip_ref
from bundlelake.operators import incremental as INC
from bundlelake.operators import marts as M
from bundlelake.operators import partials as P
from bundlelake.operators import quality as Q
from bundlelake.operators import serving as S
from bundlelake.operators.entries import bundle_entries, entries_of_type, entry_type_counts, malformed_bundles
from bundlelake.operators.staging import cast_rejects, dedup_latest, flatten, model_types
from bundlelake.plans import current as CUR
from bundlelake.plans import retention as RET
from bundlelake.plans import rollups as R
from bundlelake.plans import versions as V
from bundlelake.plans.pipeline import run_pipeline, update_typed_entries
from bundlelake.schemas import STAGING_SPECS
from bundlelake.session import apply_conf, scratch_path
from bundlelake.sources import landing as L
from bundlelake.streaming.ingest import due_again, run_available_now
from bundlelake.testing import manifests as DM
from bundlelake.testing import oracle as O
from bundlelake.testing.build import Build, written_landing
from bundlelake.testing.files import write_archives, write_files
from bundlelake.testing.fixtures import bundle_files, read_table
from bundlelake.testing.oracle_compat import for_oracle

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return run
    return deco


def _b(spark, sf_dir) -> Build:
    return Build.from_tables(spark, sf_dir)


def _landing(spark, sf_dir) -> DataFrame:
    return written_landing(spark, sf_dir)


# --- staging models --------------------------------------------------------
for _m in STAGING_SPECS:
    register(_m, O.staging_sql(_m))(
        (lambda m: lambda spark, sf_dir: for_oracle(_b(spark, sf_dir).stg(m)))(_m))

# --- marts -----------------------------------------------------------------
for _m in O.MARTS:
    register(_m, O.mart_sql(_m))(
        (lambda m: lambda spark, sf_dir: for_oracle(_b(spark, sf_dir).mart(m)))(_m))


# --- serving ---------------------------------------------------------------
@register("vitals_summary", O.with_marts("""
SELECT observation_description, round(avg(value_quantity), 6) AS avg_value, value_unit, count(*) AS sample_size
FROM fct_vitals WHERE value_quantity IS NOT NULL
GROUP BY observation_description, value_unit HAVING count(*) > 10
""", "fct_vitals"))
def _vitals_summary(spark, sf_dir):
    """E5: average and count per vital and unit, groups of more than 10."""
    return for_oracle(S.vitals_summary(_b(spark, sf_dir).mart("fct_vitals")), round_cols=("avg_value",))


# --- entries and JSON functions ------------------------------------------------



@register("json_parse_props", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def _json_parse_props(spark, sf_dir):
    """B1: parse a JSON text column and read one scalar path."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", json_scalar(F.parse_json("props"), "$.k").alias("k"))


@register("bundle_entries", O.BUNDLE_ENTRIES)
def _bundle_entries(spark, sf_dir):
    """One row per bundle entry with its position and resource type."""
    e = bundle_entries(_landing(spark, sf_dir))
    return for_oracle(e.select("file_path", "ingestion_timestamp", "pos", "resource_type",
                               json_scalar("entry", "$.resource.id").alias("resource_id")))


@register("entries_by_resource_type",
          f"SELECT resource_type, count(*) AS n_entries FROM ({O.BUNDLE_ENTRIES}) e GROUP BY 1")
def _entries_by_type(spark, sf_dir):
    """Entries per resource type."""
    return entry_type_counts(bundle_entries(_landing(spark, sf_dir)))


@register("json_scalar_paths", f"""
SELECT 'pat-' || CAST(k AS VARCHAR) AS patient_id, fp AS file_path,
  CAST(NULL AS VARCHAR) AS name_value, CAST(NULL AS VARCHAR) AS marital_value,
  ['Married','Never Married','Divorced'][k % 3 + 1] AS marital_text,
  ['male','female','other','unknown'][k % 4 + 1] AS gender,
  CASE WHEN k % 7 = 0 THEN CAST(k % 3 + 1 AS VARCHAR) END AS multiple_birth_text,
  CASE WHEN k % 3 = 0 THEN 'M' END AS middle_name,
  CAST(NULL AS VARCHAR) AS missing_value
FROM (SELECT c_custkey AS k, 'raw/fhir/' || rs || 'patient/pat-' || CAST(c_custkey AS VARCHAR) || '.json' AS fp
      FROM customer, (SELECT 1 AS l, '' AS rs UNION ALL SELECT 2, 'resend/') loads
      WHERE l = 1 OR c_custkey % 5 = 0) p
""")
def _json_scalar_paths(spark, sf_dir):
    """Scalar extraction - arrays/objects and missing paths give NULL."""
    e = entries_of_type(bundle_entries(_landing(spark, sf_dir)), "Patient")
    return e.select(
        json_scalar("entry", "$.resource.id").alias("patient_id"), "file_path",
        json_scalar("entry", "$.resource.name").alias("name_value"),
        json_scalar("entry", "$.resource.maritalStatus").alias("marital_value"),
        json_scalar("entry", "$.resource.maritalStatus.text").alias("marital_text"),
        json_scalar("entry", "$.resource.gender").alias("gender"),
        json_scalar("entry", "$.resource.multipleBirthInteger").alias("multiple_birth_text"),
        json_scalar("entry", "$.resource.name[0].given[1]").alias("middle_name"),
        json_scalar("entry", "$.resource.notAField").alias("missing_value"))


@register("reference_strip", f"""
SELECT 'med-' || CAST(o AS VARCHAR) AS medication_request_id,
  'urn:uuid:pat-' || CAST(c AS VARCHAR) AS subject_reference, 'pat-' || CAST(c AS VARCHAR) AS patient_id,
  'Practitioner?identifier=' || CAST(o % 5 AS VARCHAR) AS requester_reference,
  'Practitioner?identifier=' || CAST(o % 5 AS VARCHAR) AS requester_id
FROM (SELECT o_orderkey AS o, o_custkey AS c FROM orders
      WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) v,
     (SELECT 1 AS l UNION ALL SELECT 2) loads
WHERE l = 1 OR c % 5 = 0
""")
def _reference_strip(spark, sf_dir):
    """Strip 'urn:uuid:' from references; other forms pass through."""
    e = entries_of_type(bundle_entries(_landing(spark, sf_dir)), "MedicationRequest")
    subj = json_scalar("entry", "$.resource.subject.reference")
    req = json_scalar("entry", "$.resource.requester.reference")
    return e.select(json_scalar("entry", "$.resource.id").alias("medication_request_id"),
                    subj.alias("subject_reference"), strip_ref(subj).alias("patient_id"),
                    req.alias("requester_reference"), strip_ref(req).alias("requester_id"))


@register("dedup_latest", O.with_staging("""
SELECT observation_id, CAST(CASE WHEN file_path LIKE 'raw/fhir/resend/%' THEN 2 ELSE 1 END AS BIGINT) AS n_copies,
       file_path, value_quantity
FROM stg_observations
""", "stg_observations"))
def _dedup_latest(spark, sf_dir):
    """Latest copy per id, with the number of copies there were.  The
    flattened rows are written, so that the bundles are parsed once."""
    spec = STAGING_SPECS["stg_observations"]
    flat = flatten(entries_of_type(bundle_entries(_landing(spark, sf_dir)), "Observation"), spec["columns"])
    at = scratch_path(spark, "observations")
    flat.select("observation_id", "file_path", "ingestion_timestamp", "_pos", "value_quantity").write.parquet(at)
    flat = spark.read.parquet(at)
    copies = flat.groupBy("observation_id").agg(F.count("*").alias("n_copies"))
    return dedup_latest(flat, "observation_id").join(copies, "observation_id").select(
        "observation_id", "n_copies", "file_path", "value_quantity")


# --- joins / aggregates / incremental ---------------------------------------------

@register("patient_encounter_stats", O.with_staging("""
SELECT patient_id, min(start_time) AS first_encounter_date, max(start_time) AS last_encounter_date,
       count(*) AS total_encounters FROM stg_encounters GROUP BY 1
""", "stg_encounters"))
def _patient_encounter_stats(spark, sf_dir):
    """MIN/MAX/COUNT of encounters per patient."""
    return M.patient_encounter_stats(_b(spark, sf_dir).stg("stg_encounters"))


@register("age_in_years", O.with_staging("""
SELECT patient_id, birth_date, date_sub('year', birth_date, DATE '2024-12-31') AS age_at_year_end,
       date_sub('year', birth_date, DATE '1970-06-15') AS age_at_1970, date_sub('year', birth_date, DATE '2001-02-28') AS age_at_2001
FROM stg_patients
""", "stg_patients"))
def _age_in_years(spark, sf_dir):
    """Elapsed whole years, negative (truncated toward zero) before birth;
    some are born on February 29."""
    from bundlelake.functions.json import age_in_years
    p = _b(spark, sf_dir).stg("stg_patients")
    return p.select("patient_id", "birth_date",
                    age_in_years(F.col("birth_date"), F.lit("2024-12-31").cast("date")).alias("age_at_year_end"),
                    age_in_years(F.col("birth_date"), F.lit("1970-06-15").cast("date")).alias("age_at_1970"),
                    age_in_years(F.col("birth_date"), F.lit("2001-02-28").cast("date")).alias("age_at_2001"))


def _load1_build(spark, sf_dir) -> Build:
    return Build.from_tables(spark, sf_dir, loads=(1,))


@register("incremental_filter", O.with_staging("""
SELECT observation_id, ingested_at, value_quantity FROM stg_observations
WHERE ingested_at > TIMESTAMP '2024-02-01 00:00:00'
""", "stg_observations"))
def _incremental_filter(spark, sf_dir):
    """C11: source rows newer than the target's watermark (scalar subquery)."""
    target = _load1_build(spark, sf_dir).mart("fct_vitals")
    src = _b(spark, sf_dir).stg("stg_observations")
    return for_oracle(INC.incremental_filter(src, target).select("observation_id", "ingested_at", "value_quantity"))


@register("incremental_upsert", O.mart_sql("fct_vitals"))
def _incremental_upsert(spark, sf_dir):
    """Keyed upsert of an incremental build onto the previous one."""
    target = _load1_build(spark, sf_dir).mart("fct_vitals")
    full = _b(spark, sf_dir)  # its models were extracted for the target
    new_rows = INC.incremental_filter(full.stg("stg_observations"), target)
    increment = M.fct_vitals(new_rows, full.stg("stg_patients"))
    return for_oracle(INC.upsert(target, increment, "observation_id"))


# --- data quality -----------------------------------------------------------------

@register("dq_unique", O.with_staging("""
SELECT allergy_id, count(*) AS n_rows FROM stg_allergy_intolerances GROUP BY 1 HAVING count(*) > 1
""", "stg_allergy_intolerances"))
def _dq_unique(spark, sf_dir):
    """Duplicated keys (the allergy model keeps re-sent copies)."""
    return Q.unique(_b(spark, sf_dir).stg("stg_allergy_intolerances"), "allergy_id")


@register("dq_not_null", O.with_marts("SELECT patient_id, race FROM dim_patients WHERE race IS NULL", "dim_patients"))
def _dq_not_null(spark, sf_dir):
    """Rows with a NULL in the tested column."""
    return Q.not_null(_b(spark, sf_dir).mart("dim_patients"), "race").select("patient_id", "race")


@register("dq_accepted_values", O.with_staging("""
SELECT status, count(*) AS n_rows FROM stg_encounters
WHERE status IS NOT NULL AND status NOT IN ('finished', 'in-progress', 'cancelled') GROUP BY 1
""", "stg_encounters"))
def _dq_accepted_values(spark, sf_dir):
    """D3: values outside an accepted list."""
    return Q.accepted_values(_b(spark, sf_dir).stg("stg_encounters"), "status",
                             ["finished", "in-progress", "cancelled"])


@register("dq_relationships", O.with_marts("""
SELECT observation_id, patient_id FROM fct_vitals v
WHERE patient_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_patients d WHERE d.patient_id = v.patient_id)
""", "fct_vitals", "dim_patients"))
def _dq_relationships(spark, sf_dir):
    """Facts whose patient is missing from the dimension."""
    b = _b(spark, sf_dir)
    vitals, dim = b.marts_of("fct_vitals", "dim_patients").values()
    return Q.relationships(vitals, "patient_id", dim, "patient_id") \
        .select("observation_id", "patient_id")


@register("dq_report", O.with_all(O.audit_sql(Q.ALL_CHECKS)))
def _dq_report(spark, sf_dir):
    """All 61 declared tests with their violation counts."""
    return Q.audit(_b(spark, sf_dir).layers())


@register("dq_freshness", """
SELECT CAST(max(t) AS TIMESTAMP) AS max_loaded_at,
       CAST(date_diff('second', max(t), TIMESTAMP '2024-03-02 12:00:00') AS DOUBLE) / 3600.0 AS age_hours,
       date_diff('second', max(t), TIMESTAMP '2024-03-02 12:00:00') / 3600.0 <= 48.0 AS is_fresh
FROM (SELECT CASE WHEN c_custkey % 5 = 0 THEN TIMESTAMP '2024-03-01 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS t
      FROM customer) l
""")
def _dq_freshness(spark, sf_dir):
    """Age of the newest load against a threshold."""
    return for_oracle(Q.freshness(_landing(spark, sf_dir), "2024-03-02 12:00:00", 48.0))


# --- serving -----------------------------------------------------------------------

@register("demographics", O.with_marts("SELECT gender, race, ethnicity, age_years FROM dim_patients", "dim_patients"))
def _demographics(spark, sf_dir):
    """Demographics projection of the patient dimension."""
    return S.demographics(_b(spark, sf_dir).mart("dim_patients"))


@register("top_conditions", O.with_marts("""
SELECT condition_description, count(*) AS count FROM fct_conditions GROUP BY 1
ORDER BY count DESC, condition_description ASC NULLS LAST LIMIT 10
""", "fct_conditions"))
def _top_conditions(spark, sf_dir):
    """Ten most frequent condition descriptions."""
    return S.top_conditions(_b(spark, sf_dir).mart("fct_conditions"))


@register("top_medications", O.with_marts("""
SELECT medication_description, count(*) AS count FROM fct_medications GROUP BY 1
ORDER BY count DESC, medication_description ASC NULLS LAST LIMIT 10
""", "fct_medications"))
def _top_medications(spark, sf_dir):
    """Ten most frequent medications."""
    return S.top_medications(_b(spark, sf_dir).mart("fct_medications"))


@register("encounter_trends", O.with_marts("""
SELECT CAST(date_trunc('month', start_time) AS DATE) AS month, count(*) AS count FROM fct_encounters GROUP BY 1
""", "fct_encounters"))
def _encounter_trends(spark, sf_dir):
    """Encounters per month."""
    return S.encounter_trends(_b(spark, sf_dir).mart("fct_encounters"))


@register("age_histogram", O.with_marts("""
SELECT CAST(lo + floor((age_years - lo) / w) * w AS BIGINT) AS age_bin_start, CAST(w AS BIGINT) AS bin_width,
       gender, count(*) AS count
FROM dim_patients, (SELECT min(age_years) AS lo,
                           greatest(1, ceil((max(age_years) - min(age_years) + 1) / 20.0)) AS w FROM dim_patients) b
WHERE age_years IS NOT NULL GROUP BY 1, 2, 3
""", "dim_patients"))
def _age_histogram(spark, sf_dir):
    """At most 20 equal-width age bins split by gender."""
    return S.age_histogram(_b(spark, sf_dir).mart("dim_patients"))


@register("race_distribution", O.with_marts("""
SELECT race, count(*) AS count, round(count(*) / (SELECT count(*) FROM dim_patients), 6) AS share
FROM dim_patients GROUP BY 1
""", "dim_patients"))
def _race_distribution(spark, sf_dir):
    """Patients and share per race."""
    return for_oracle(S.race_distribution(_b(spark, sf_dir).mart("dim_patients")), round_cols=("share",))


@register("kpis", O.with_marts("""
SELECT (SELECT count(*) FROM dim_patients) AS total_patients,
  (SELECT count(*) FROM (SELECT condition_description FROM fct_conditions GROUP BY 1 LIMIT 10) t) AS unique_conditions_shown,
  (SELECT count(DISTINCT condition_description) FROM fct_conditions) AS unique_conditions,
  (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) FROM (SELECT count(*) AS c FROM fct_medications GROUP BY medication_description
     ORDER BY c DESC, medication_description ASC NULLS LAST LIMIT 10) t) AS active_medications_shown,
  (SELECT count(*) FILTER (WHERE medication_status = 'active') FROM fct_medications) AS active_medications,
  (SELECT coalesce(max_by(c, m), 0) FROM (SELECT date_trunc('month', start_time) AS m, count(*) AS c
     FROM fct_encounters GROUP BY 1) t) AS latest_month_volume,
  (SELECT c FROM (SELECT date_trunc('month', start_time) AS m, count(*) AS c FROM fct_encounters GROUP BY 1) t
     ORDER BY m DESC NULLS FIRST LIMIT 1) AS latest_month_volume_shown
""", "dim_patients", "fct_conditions", "fct_medications", "fct_encounters"))
def _kpis(spark, sf_dir):
    """Dashboard tiles, as shown and as true figures."""
    b = _b(spark, sf_dir)
    return S.kpis(*b.marts_of("dim_patients", "fct_conditions", "fct_medications", "fct_encounters").values())


@register("vital_lookup", O.with_marts("""
SELECT observation_description, round(avg(value_quantity), 6) AS avg_value, value_unit
FROM fct_vitals WHERE value_quantity IS NOT NULL AND observation_description = 'Obs click'
GROUP BY observation_description, value_unit HAVING count(*) > 10
ORDER BY count(*) DESC, value_unit ASC NULLS LAST LIMIT 1
""", "fct_vitals"))
def _vital_lookup(spark, sf_dir):
    """Average and unit of one selected vital (its most frequent unit)."""
    summary = S.vitals_summary(_b(spark, sf_dir).mart("fct_vitals"))
    return for_oracle(S.vital_lookup(summary, "Obs click"), round_cols=("avg_value",))


# --- ingestion (raw-file manifests from `documents`) ---------------------------------

_SIZE = f"length <= {DM.DOC_SIZE_LIMIT}"
_GOOD = f"NOT ({O.DOC_BAD})"


def _chars(df: DataFrame) -> DataFrame:
    return df.select("file_path", F.char_length("data").alias("n_chars"))


@register("ingest_manifest", f"SELECT path, length FROM ({O.DOC_JSON}) t")
def _ingest_manifest(spark, sf_dir):
    """A1/A2: listed objects, keeping '.json' keys only."""
    return L.json_keys(DM.document_manifest(spark, sf_dir)).select("path", "length")


@register("ingest_size_guard", f"SELECT path, length FROM ({O.DOC_JSON}) t WHERE {_SIZE}")
def _ingest_size_guard(spark, sf_dir):
    """A3: files over the size limit are skipped (the limit itself is kept)."""
    return L.size_guard(L.json_keys(DM.document_manifest(spark, sf_dir)), DM.DOC_SIZE_LIMIT).select("path", "length")


@register("ingest_pending_antijoin", f"SELECT path, length FROM ({O.DOC_PENDING}) t")
def _ingest_pending(spark, sf_dir):
    """A4: files whose path is not yet in the landing table."""
    m = L.json_keys(DM.document_manifest(spark, sf_dir))
    return L.pending(m, DM.labelled_landing(spark, sf_dir)).select("path", "length")


@register("ingest_batch_cap", f"SELECT path, length FROM (SELECT * FROM ({O.DOC_PENDING}) t ORDER BY path LIMIT 100) c WHERE {_GOOD}")
def _ingest_batch_cap(spark, sf_dir):
    """A5: at most 100 files per run, first by path."""
    batch = L.incremental_batch(DM.document_manifest(spark, sf_dir), DM.labelled_landing(spark, sf_dir), max_files=DM.DOC_CAP)
    return batch.select(F.col("file_path").alias("path"), F.octet_length("data").cast("long").alias("length"))


@register("ingest_decode_rejects", f"SELECT path AS file_path, length FROM ({O.DOC_PENDING}) t WHERE {O.DOC_BAD}")
def _ingest_decode_rejects(spark, sf_dir):
    """Pending files that are not valid UTF-8."""
    m = L.pending(L.json_keys(DM.document_manifest(spark, sf_dir)), DM.labelled_landing(spark, sf_dir))
    return L.decode_rejects(m)


@register("ingest_decode", f"SELECT path AS file_path, n_chars FROM ({O.DOC_PENDING}) t WHERE {_GOOD}")
def _ingest_decode(spark, sf_dir):
    """UTF-8 decode of the accepted files."""
    m = L.pending(L.json_keys(DM.document_manifest(spark, sf_dir)), DM.labelled_landing(spark, sf_dir))
    return _chars(L.decode(m))


@register("ingest_skip_report", f"""
SELECT path AS file_path, length, CASE WHEN {_SIZE} THEN 'not UTF-8' ELSE 'too large' END AS reason
FROM ({O.DOC_PENDING}) t WHERE NOT ({_SIZE}) OR {O.DOC_BAD}
""")
def _ingest_skip_report(spark, sf_dir):
    """What two runs with a size limit left out, and why (each file once)."""
    path = _seeded_landing(spark, sf_dir)
    for ts in ("2024-04-01 00:00:00", "2024-04-02 00:00:00"):
        L.ingest_incremental(spark, DM.document_manifest(spark, sf_dir), path, max_bytes=DM.DOC_SIZE_LIMIT, ingestion_timestamp=ts)
    return L.read_skipped(spark, path).select("file_path", "length", "reason")


def _seeded_landing(spark, sf_dir) -> str:
    """A landing table that holds the already-ingested files."""
    path = scratch_path(spark, "landing")
    L.append_landing(DM.labelled_landing(spark, sf_dir), path)
    return path


@register("landing_append", f"""
SELECT path AS file_path, n_chars,
       CASE WHEN doc_id % 2 = 1 THEN TIMESTAMP '2024-04-01 00:00:00' ELSE TIMESTAMP '2024-04-02 00:00:00' END AS ingestion_timestamp
FROM ({O.DOC_PENDING}) t WHERE {_GOOD}
""")
def _landing_append(spark, sf_dir):
    """Two hourly runs appending to a landing table seeded with the
    already-ingested files.  The first sees the files of odd documents, the
    second sees all and skips what the first loaded."""
    path = _seeded_landing(spark, sf_dir)
    m = DM.document_manifest(spark, sf_dir)
    L.ingest_incremental(spark, m.where(m.path.rlike("[13579]\\.json$")), path, ingestion_timestamp="2024-04-01 00:00:00")
    L.ingest_incremental(spark, m, path, ingestion_timestamp="2024-04-02 00:00:00")
    out = L.read_landing(spark, path).where(F.col("ingestion_timestamp") > F.lit(DM.DOC_LOAD_TS).cast("timestamp"))
    return for_oracle(out.select("file_path", F.char_length("data").alias("n_chars"), "ingestion_timestamp"))


@register("landing_full_refresh", f"""
SELECT path AS file_path, n_chars, TIMESTAMP '2024-04-03 00:00:00' AS ingestion_timestamp FROM ({O.DOC_JSON}) t WHERE {_GOOD}
""")
def _landing_full_refresh(spark, sf_dir):
    """Replace the landing table with every current file (twice: same result)."""
    path = _seeded_landing(spark, sf_dir)
    for _ in range(2):
        L.ingest_full_refresh(spark, DM.document_manifest(spark, sf_dir), path, ingestion_timestamp="2024-04-03 00:00:00")
    out = L.read_landing(spark, path)
    return for_oracle(out.select("file_path", F.char_length("data").alias("n_chars"), "ingestion_timestamp"))


def _document_files(spark, sf_dir) -> str:
    root = scratch_path(spark, "raw-docs")
    write_files(DM.document_objects(spark, sf_dir), root).count()
    return root


@register("ingest_files_full_refresh", f"SELECT path AS file_path, n_chars FROM ({O.DOC_JSON}) t WHERE {_GOOD}")
def _ingest_files_full_refresh(spark, sf_dir):
    """A1/A2/A6/A8 on real files: recursive listing, '.json' filter, decode,
    landing write."""
    root = _document_files(spark, sf_dir)
    landing = scratch_path(spark, "landing-files")
    L.ingest_full_refresh(spark, L.relative_paths(L.list_files(spark, root), root), landing)
    return _chars(L.read_landing(spark, landing))


@register("stream_ingest_available_now", f"SELECT path AS file_path, n_chars FROM ({O.DOC_JSON}) t WHERE {_GOOD}")
def _stream_ingest(spark, sf_dir):
    """A10: Structured Streaming file source, availableNow trigger; a second
    run finds nothing new."""
    root = _document_files(spark, sf_dir)
    landing, ckpt = scratch_path(spark, "landing-stream"), scratch_path(spark, "stream-ckpt")
    for _ in range(2):
        run_available_now(spark, root, landing, ckpt)
    return _chars(L.read_landing(spark, landing))


@register("stream_then_batch", f"SELECT path AS file_path, n_chars FROM ({O.DOC_JSON}) t")
def _stream_then_batch(spark, sf_dir):
    """Stream and batch take turns on one landing table (a third of
    the files before each run), then the undecodable files are repaired.  No
    file is lost or landed twice."""
    root, landing, ckpt = (scratch_path(spark, x) for x in ("raw-turns", "landing-turns", "ckpt-turns"))
    objects = DM.document_objects(spark, sf_dir)
    part = F.pmod(F.crc32(F.encode("path", "UTF-8")), F.lit(3))
    for turn in range(3):
        write_files(objects.where(part == turn), root).count()
        if turn == 1:
            L.ingest_incremental(spark, L.relative_paths(L.list_files(spark, root), root), landing)
        else:
            run_available_now(spark, root, landing, ckpt)
    write_files(DM.repaired_objects(spark, sf_dir), root).count()
    run_available_now(spark, root, landing, ckpt)
    return _chars(L.read_landing(spark, landing))


@register("stream_retry_due", f"""
SELECT path, length + (CASE WHEN doc_id % 2 = 1 AND {O.DOC_BAD} THEN 1 ELSE 0 END) AS length
FROM ({O.DOC_PENDING}) t WHERE ({O.DOC_BAD} AND doc_id % 2 = 1 AND length < 2 * {DM.DOC_SIZE_LIMIT})
  OR (NOT ({_SIZE}) AND length <= 2 * {DM.DOC_SIZE_LIMIT} AND NOT ({O.DOC_BAD} AND doc_id % 2 = 1))
""")
def _stream_retry_due(spark, sf_dir):
    """A10: which rejects of a run with a size limit the next run tries again,
    whose limit is twice as large: those that now fit, and the undecodable
    ones that were changed since (odd documents: one byte longer)."""
    path = _seeded_landing(spark, sf_dir)
    m = DM.document_manifest(spark, sf_dir).withColumn("modificationTime", F.lit("2024-03-31 12:00:00").cast("timestamp"))
    L.ingest_incremental(spark, m, path, max_bytes=DM.DOC_SIZE_LIMIT, ingestion_timestamp="2024-04-01 00:00:00")
    doc = F.regexp_extract("path", r"(\d+)\.json$", 1).try_cast("long")
    changed = (doc % 17 == 5) & (doc % 2 == 1)
    now = m.select("path", F.when(changed, F.col("length") + 1).otherwise(F.col("length")).alias("length"),
                   F.when(changed, F.lit("2024-04-01 12:00:00").cast("timestamp")).otherwise(F.col("modificationTime")).alias("modificationTime"))
    return due_again(now, L.read_skipped(spark, path), L.read_landing(spark, path), 2 * DM.DOC_SIZE_LIMIT).select("path", "length")


@register("full_refresh_generation", f"""
SELECT resource_type, count(*) AS n_entries FROM ({O.BUNDLE_ENTRIES}) e WHERE ingestion_timestamp = TIMESTAMP '2024-02-01 00:00:00' GROUP BY 1
""")
def _full_refresh_generation(spark, sf_dir):
    """Landing and typed entries after a full refresh from a prefix that
    no longer holds the second load's files."""
    base = scratch_path(spark, "generations")
    for loads in ((1, 2), (1,)):
        m = bundle_files(spark, sf_dir, *loads).select(
            F.col("file_path").alias("path"), F.octet_length("data").cast("long").alias("length"), F.encode("data", "UTF-8").alias("content"))
        L.ingest_full_refresh(spark, m, f"{base}/landing")
        at = f"{base}/typed_entries/{L.generation(spark, f'{base}/landing')}"
        typed = update_typed_entries(spark, L.read_landing(spark, f"{base}/landing"), at)
    return entry_type_counts(typed)


# --- bad data in bundles ---------------------------------------------------------------------

@register("entry_not_array_rejects", """
SELECT 'doc-' || CAST(doc_id AS VARCHAR) || '.json' AS file_path,
  CASE WHEN doc_id % 6 = 3 THEN 'not JSON' ELSE 'entry is not an array' END AS reason
FROM documents WHERE doc_id % 6 IN (0, 1, 3)
""")
def _entry_not_array(spark, sf_dir):
    """Bundles whose ``entry`` is an object or a scalar, and text that
    is no JSON (missing, null and empty-array entries are no rejects)."""
    k = F.col("doc_id") % 6
    data = (F.when(k == 0, F.lit('{"entry":{"resource":{}}}')).when(k == 1, F.lit('{"entry":5}')).when(k == 2, F.lit('{"id":"x"}'))
            .when(k == 3, F.lit('{"entry":')).when(k == 4, F.lit('{"entry":null}')).otherwise(F.lit('{"entry":[]}')))
    rows = read_table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".json")).alias("file_path"), data.alias("data"),
        F.lit(DM.DOC_LOAD_TS).cast("timestamp").alias("ingestion_timestamp"))
    return malformed_bundles(rows).select("file_path", "reason")


@register("cast_rejects", """
SELECT 'c-' || CAST(c_custkey AS VARCHAR) AS file_path, 0 AS pos, 'Patient' AS resource_type, 'birth_date' AS "column", c_name AS text
FROM customer WHERE c_custkey % 7 = 0
UNION ALL SELECT 'c-' || CAST(c_custkey AS VARCHAR), 1, 'Observation', 'value_quantity', c_mktsegment FROM customer WHERE c_custkey % 5 = 0
""")
def _cast_rejects(spark, sf_dir):
    """Values that a date or number column does not accept."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    patient = F.struct(F.lit("Patient").alias("resourceType"), F.when(k % 7 == 0, F.col("c_name")).otherwise(F.lit("1980-02-03")).alias("birthDate"))
    value = F.when(k % 5 == 0, F.col("c_mktsegment")).otherwise(F.lit("1.5"))
    obs = F.struct(F.lit("Observation").alias("resourceType"), F.struct(value.alias("value")).alias("valueQuantity"))
    text = F.concat(F.lit('{"entry":[{"resource":'), F.to_json(patient), F.lit('},{"resource":'), F.to_json(obs), F.lit("}]}"))
    rows = c.select(F.concat(F.lit("c-"), k.cast("string")).alias("file_path"), text.alias("data"),
                    F.lit(DM.DOC_LOAD_TS).cast("timestamp").alias("ingestion_timestamp"))
    return cast_rejects(model_types(bundle_entries(rows, "quarantine"))).drop("ingestion_timestamp")


# --- versions: write-audit-publish ------------------------------------------------------


@register("wap_publish", O.with_all(
    "SELECT model, test, \"column\", violations, 'v1' AS label, false AS published FROM ("
    + O.audit_sql(Q.ALL_CHECKS) + ") r"))
def _wap_publish(spark, sf_dir):
    """write a build under a label, audit the written tables, publish
    only on a clean audit (this build has dangling observation subjects
    and re-sent allergies, so the label must stay unpublished)."""
    return V.write_audit_publish(spark, _b(spark, sf_dir).tables(), scratch_path(spark, "versions"), "v1")


def _clean_tables(spark, sf_dir) -> dict[str, V.Table]:
    """The build without what its audit objects to (``fct_vitals`` has one row
    per row of the observations it reads)."""
    t = _b(spark, sf_dir).tables()
    real = ~F.col("patient_id").startswith("ghost-")
    return t | {"stg_observations": t["stg_observations"].where(real),
                "stg_allergy_intolerances": t["stg_allergy_intolerances"].dropDuplicates(["allergy_id"])}


@register("wap_publish_clean", "SELECT * FROM (VALUES " + ", ".join(
    f"('{c.model}', '{c.test}', '{c.column}', CAST(0 AS BIGINT), 'v1', true)" for c in Q.ALL_CHECKS)
    + ") t(model, test, \"column\", violations, label, published)")
def _wap_publish_clean(spark, sf_dir):
    """A build that passes all 61 tests goes live."""
    return V.write_audit_publish(spark, _clean_tables(spark, sf_dir), scratch_path(spark, "versions"), "v1")


def _dim_versions(spark, sf_dir) -> str:
    """v1 published; v2 fails its audit; v3 is written and audited but
    published by hand only; v4 breaks off before its audit."""
    root = scratch_path(spark, "versions")
    dim = _b(spark, sf_dir).layers("dim_patients")["dim_patients"]
    checks = [c for c in Q.MART_CHECKS if c.model == "dim_patients"]
    V.write_audit_publish(spark, {"dim_patients": dim}, root, "v1", checks)
    V.write_audit_publish(spark, {"dim_patients": dim.unionByName(dim)}, root, "v2", checks)
    for label in ("v3", "v4"):
        V.claim_label(spark, root, label)
        V.write_tables({"dim_patients": dim}, root, label)
        if label == "v3":
            V.audit_step(spark, root, label, {"dim_patients": dim}, checks)
    return root


def _attempts(spark, root: str, do, labels) -> DataFrame:
    """(label, refused): what each attempt came to."""
    out = []
    for label in labels:
        try:
            do(label)
            out.append((label, None))
        except ValueError as e:
            out.append((label, type(e).__name__))
    return spark.createDataFrame(out, "label string, refused string")


@register("wap_same_label_refused", O.with_marts("""
SELECT label, CASE WHEN label <> 'v5' THEN 'LabelTaken' END AS refused, n FROM (SELECT unnest(['v1', 'v2', 'v3', 'v4', 'v5']) AS label) l,
  (SELECT count(*) AS n FROM dim_patients) d
""", "dim_patients"))
def _wap_same_label(spark, sf_dir):
    """labels are used once, published or not; what readers see (n rows)
    does not change by a refused build."""
    root = _dim_versions(spark, sf_dir)
    done = _attempts(spark, root, lambda x: V.claim_label(spark, root, x), ["v1", "v2", "v3", "v4", "v5"])
    n = V.read_version(spark, root, "dim_patients").agg(F.count("*")).select(F.col("count(1)").alias("n"))
    return done.withColumn("n", n.scalar())


@register("promote_version", "SELECT * FROM (VALUES ('v1', NULL, 'v3'), ('v2', 'NotPublishable', 'v3'), ('v3', NULL, 'v3'), "
          "('v4', 'NotPublishable', 'v3'), ('never', 'NotPublishable', 'v3')) t(label, refused, current)")
def _promote_version(spark, sf_dir):
    """promoting a version by hand: only one that was written and passed."""
    root = _dim_versions(spark, sf_dir)
    done = _attempts(spark, root, lambda x: V.publish(spark, root, x), ["v1", "v2", "v3", "v4", "never"])
    return done.withColumn("current", F.lit(V.current_label(spark, root)))


@register("list_versions", "SELECT * FROM (VALUES ('v1', 'dim_patients', true, true), ('v2', 'dim_patients', false, false), "
          "('v3', 'dim_patients', false, false), ('v4', 'dim_patients', false, false)) t(label, tables, published, current)")
def _list_versions(spark, sf_dir):
    """the versions with their state."""
    v = V.list_versions(spark, _dim_versions(spark, sf_dir))
    return v.select("label", F.array_join("tables", ",").alias("tables"), "published", "current")


@register("unreachable_versions", O.with_marts("""
SELECT label, reason, CAST(n * CASE WHEN label = 'v2' THEN 2 ELSE 1 END AS BIGINT) AS n_rows
FROM (VALUES ('v2', 'failed its audit'), ('v1', 'replaced')) l(label, reason), (SELECT count(*) AS n FROM dim_patients) d
""", "dim_patients"))
def _unreachable_versions(spark, sf_dir):
    """versions nobody reads once v3 has been promoted and nothing older
    is kept, with the rows they hold; v3 is current, v4 can be resumed."""
    root = _dim_versions(spark, sf_dir)
    V.publish(spark, root, "v3")
    out = RET.sweep(spark, root, keep=0).where("kind = 'version'").select(F.col("name").alias("label"), "reason")
    n = [V.read_version(spark, root, "dim_patients", x).agg(F.count("*").alias("n_rows")).withColumn("label", F.lit(x)) for x in ("v1", "v2", "v3", "v4")]
    return out.join(reduce(DataFrame.unionByName, n), "label")


@register("read_version", O.mart_sql("dim_patients"))
def _read_version(spark, sf_dir):
    """read a table of the current version."""
    return for_oracle(V.read_version(spark, _dim_versions(spark, sf_dir), "dim_patients"))


# --- the scheduled job end to end (files -> landing -> models -> audit -> publish) ----------


@register("pipeline_run", O.with_all(
    "SELECT model, test, \"column\", violations, 'v2' AS label, false AS published FROM ("
    + O.audit_sql(Q.ALL_CHECKS) + ") r"))
def _pipeline_run(spark, sf_dir):
    """Two scheduled runs over real bundle files (members of ZIP
    archives).  Run 1 ingests the first load's files and builds v1; then the re-sent files arrive and
    run 2 ingests only those (ledger), and builds and audits v2.  The audit
    finds the re-sent allergies, which no mart reads, so the marts are built
    too, and the observations of unknown patients; v2 does not go live."""
    raw = scratch_path(spark, "raw-bundles")
    root = scratch_path(spark, "lake")
    for load, label in ((1, "v1"), (2, "v2")):
        files = bundle_files(spark, sf_dir, load).select(F.col("file_path").alias("path"), F.col("data").alias("body"))
        write_archives(files, raw).count()
        report = run_pipeline(spark, raw, root, label, mode="incremental", as_of_date=O.AS_OF_DATE_TEXT, archives="*.zip")
    return report


# a sender that knows its patients: what was sent for an unknown one is patient 1's
_KNOWN = O.STG_OBSERVATIONS.replace("'ghost-' || CAST(event_id AS VARCHAR)", "'pat-1'")


@register("pipeline_run_clean", "SELECT * EXCLUDE (ingested_at), 'v2' AS label, CAST(" + str(len(Q.ALL_CHECKS)) + " AS BIGINT) AS n_passed FROM ("
          + O.FCT_VITALS_BODY.replace(O.STG_OBSERVATIONS, _KNOWN) + ") t")
def _pipeline_run_clean(spark, sf_dir):
    """Two scheduled runs whose files pass every test, copies
    of allergies merged.  Run 2 breaks off while it writes marts and is run
    again under its label; it goes live.  Rows: ``fct_vitals`` as readers of
    the current version see it, with the version's label and number of
    passed tests."""
    raw, root = scratch_path(spark, "raw-bundles"), scratch_path(spark, "lake")
    for load, label in ((1, "v1"), (2, "v2")):
        data = F.regexp_replace("data", r"urn:uuid:ghost-\d+", "urn:uuid:pat-1")
        write_archives(bundle_files(spark, sf_dir, load).select(F.col("file_path").alias("path"), data.alias("body")), raw).count()
        if load == 2:
            _left_by_a_broken_run(spark, root, label)
        run_pipeline(spark, raw, root, label, mode="incremental", as_of_date=O.AS_OF_DATE_TEXT, dedup_allergies=True, archives="*.zip")
    live = V.current_label(spark, root)
    passed = V.audit_report(spark, root, live).where("violations = 0").count()
    vitals = for_oracle(V.read_version(spark, root, "fct_vitals")).drop("ingested_at")
    return vitals.withColumn("label", F.lit(live)).withColumn("n_passed", F.lit(passed).cast("long"))


def _left_by_a_broken_run(spark, root: str, label: str) -> None:
    """What a run leaves that claims its label, writes and audits a part of
    its staging, and ends: tables of the version before under the new label."""
    V.claim_label(spark, root, label)
    old = {m: V.read_version(spark, root, m) for m in ("stg_patients", "stg_encounters", "dim_patients")}
    V.write_tables(old, root, label)
    V.audit_step(spark, root, label, old, [c for c in Q.STAGING_CHECKS if c.model in old], final=False)


@register("wap_resume", O.with_marts("""
SELECT l.label, refused, n * copies AS n, 'v4' AS current
FROM (VALUES ('v1', 'LabelTaken', 1), ('v2', 'LabelTaken', 2), ('v3', 'LabelTaken', 1), ('v4', NULL, 1)) l(label, refused, copies),
  (SELECT count(*) AS n FROM dim_patients) d
""", "dim_patients"))
def _wap_resume(spark, sf_dir):
    """a build that broke off before its last audit is resumed under its
    label and goes live; labels audited to the end are refused, passed or
    not, and keep their rows."""
    root = _dim_versions(spark, sf_dir)
    dim = _b(spark, sf_dir).layers("dim_patients")["dim_patients"]
    checks = [c for c in Q.MART_CHECKS if c.model == "dim_patients"]
    labels = ["v1", "v2", "v3", "v4"]
    done = _attempts(spark, root, lambda x: V.write_audit_publish(spark, {"dim_patients": dim}, root, x, checks, resume=True), labels)
    n = [V.read_version(spark, root, "dim_patients", x).agg(F.count("*").alias("n")).withColumn("label", F.lit(x)) for x in labels]
    return done.join(reduce(DataFrame.unionByName, n), "label").withColumn("current", F.lit(V.current_label(spark, root)))


# encounters sent again under another patient
_MOVED = "CASE WHEN o_orderkey % 11 = 3 AND o_custkey % 5 = 0 THEN 1 ELSE o_custkey END"


def _incremental_sql(mart: str) -> str:
    body = O.MARTS[mart]
    if mart == "dim_patients":
        body = body.replace("SELECT o_custkey AS k", f"SELECT {_MOVED} AS k")
    elif mart == "fct_encounters":
        body = body.replace("'pat-' || CAST(c AS VARCHAR) AS patient_id",
                            f"'pat-' || CAST({_MOVED.replace('o_orderkey', 'o').replace('o_custkey', 'c')} AS VARCHAR) AS patient_id")
    return body


_STATES: dict = {}


def _state(spark, sf_dir, mart: str) -> CUR.State:
    """Current-state tables of a mart and the models it reads: the first load
    as of an earlier day, then a second generation that meets re-sent patients
    and facts, and moved encounters (built once per session)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), mart)
    if key not in _STATES:
        root, typed = scratch_path(spark, "state"), _b(spark, sf_dir).typed_for(mart)
        first = F.col("ingestion_timestamp") < F.lit("2024-02-15").cast("timestamp")
        CUR.apply(spark, root, typed.where(first), as_of_date="2023-06-30", marts=[mart])
        again = typed.where(~first)
        if "stg_encounters" in M.sources(mart):
            moved = F.substring(F.col("stg_encounters.encounter_id"), 5, 20).cast("long") % 11 == 3
            patient = F.when(moved, F.lit("pat-1")).otherwise(F.col("stg_encounters.patient_id"))
            again = again.withColumn("stg_encounters", F.when(F.col("stg_encounters").isNotNull(),
                                                              F.col("stg_encounters").withField("patient_id", patient)))
        _STATES[key] = CUR.apply(spark, root, again, as_of_date=O.AS_OF_DATE_TEXT)
    return _STATES[key]


for _m in O.MARTS:
    register(f"incremental_{_m}", _incremental_sql(_m))(
        (lambda m: lambda spark, sf_dir: for_oracle(_state(spark, sf_dir, m).mart(m, O.AS_OF_DATE_TEXT)))(_m))


# --- aggregates that can be taken back --------------------------------------------------------

@register("patient_stats_delta", f"""
SELECT 'pat-' || CAST(k AS VARCHAR) AS patient_id, min(d) AS first_encounter_date, max(d) AS last_encounter_date, count(*) AS total_encounters
FROM (SELECT {_MOVED} AS k, CASE WHEN o_orderkey % 40 <> 17 THEN CAST(o_orderdate AS DATE) END AS d FROM orders WHERE o_orderkey % 13 <> 5) v
GROUP BY 1
""")
def _patient_stats_delta(spark, sf_dir):
    """First, last and number of encounters from counted days: those of
    the first load, and the change when a second load moves encounters to
    another patient and withdraws some."""
    was = _load1_build(spark, sf_dir).stg("stg_encounters")
    order = F.substring("encounter_id", 5, 20).cast("long")
    moved = (order % 11 == 3) & (F.substring("patient_id", 5, 20).cast("long") % 5 == 0)
    now = (_b(spark, sf_dir).stg("stg_encounters").where(order % 13 != 5)
           .withColumn("patient_id", F.when(moved, F.lit("pat-1")).otherwise(F.col("patient_id"))))
    return P.patient_stats(P.visit_days(None, was).unionByName(P.visit_days(was, now)))


def _panel(spark, sf_dir, mart: str) -> DataFrame:
    """A panel of the rollups of a mart's state, brought up generation by
    generation (the second meets facts sent again with other values)."""
    state = _state(spark, sf_dir, mart)
    for gen in range(1, state.gen + 1):
        R.update(spark, state.root, gen)
    return R.panel(spark, state.root, mart)


@register("rollup_top_conditions", ORACLE_SQL["top_conditions"])
def _rollup_top_conditions(spark, sf_dir):
    """E2 from the rollups."""
    return R.top(_panel(spark, sf_dir, "fct_conditions"), "condition_description")


@register("rollup_top_medications", ORACLE_SQL["top_medications"])
def _rollup_top_medications(spark, sf_dir):
    """E3 from the rollups."""
    return R.top(_panel(spark, sf_dir, "fct_medications"), "medication_description")


@register("rollup_encounter_trends", ORACLE_SQL["encounter_trends"])
def _rollup_encounter_trends(spark, sf_dir):
    """E4 from the rollups."""
    return R.encounter_trends(_panel(spark, sf_dir, "fct_encounters"))


@register("rollup_vitals_summary", ORACLE_SQL["vitals_summary"])
def _rollup_vitals_summary(spark, sf_dir):
    """E5 from the rollups."""
    return for_oracle(R.vitals_summary(_panel(spark, sf_dir, "fct_vitals")), round_cols=("avg_value",))
