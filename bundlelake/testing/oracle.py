"""Independent expectations: DuckDB SQL over the driver tables.

These recompute every staging/mart/serving result straight from the base
tables using the fixture rules (``fixtures.py``), never touching JSON, so
they check the parse -> explode -> extract -> dedup -> join path end to end.
Views ``customer nation region orders lineitem events documents labels``
are assumed registered.
"""

from __future__ import annotations

RESEND = 5

# birth date of customer k: every fiftieth on February 29
BIRTH = ("CASE WHEN k % 50 = 11 THEN make_date(1932 + k % 18 * 4, 2, 29) "
         "ELSE make_date(1930 + k * 13 % 75, 1 + k * 7 % 12, 1 + k * 11 % 28) END")

# --- staging models (dedup winners) ---------------------------------------

STG_PATIENTS = f"""
SELECT 'pat-' || CAST(k AS VARCHAR) AS patient_id,
  'urn:uuid:pat-' || CAST(k AS VARCHAR) AS patient_full_url,
  ['male','female','other','unknown'][k % 4 + 1] AS gender,
  {BIRTH} AS birth_date,
  c_name AS family_name,
  c_mktsegment AS given_name,
  CASE WHEN k % 3 = 0 THEN 'M' END AS middle_name,
  CAST(k AS VARCHAR) || ' Main St' AS address_line,
  n_name || CASE WHEN k % {RESEND} = 0 THEN '-moved' ELSE '' END AS city,
  r_name AS state,
  lpad(CAST(k % 100000 AS VARCHAR), 5, '0') AS postal_code,
  'US' AS country,
  CAST(k % 720 AS DOUBLE) / 8.0 - 45.0 AS latitude,
  CAST(k % 1440 AS DOUBLE) / 8.0 - 90.0 AS longitude,
  '555-' || lpad(CAST(k % 10000 AS VARCHAR), 4, '0') AS phone_number,
  ['Married','Never Married','Divorced'][k % 3 + 1] AS marital_status,
  ['English','Spanish','French','German','Chinese'][k % 5 + 1] AS primary_language,
  CASE WHEN k % 10 <> 9 THEN ['White','Black','Asian','Other'][k % 4 + 1] END AS race,
  CASE WHEN k % 10 <> 9 THEN CASE WHEN k % 6 = 0 THEN 'Hispanic or Latino' ELSE 'Not Hispanic or Latino' END END AS ethnicity,
  CASE WHEN k % 10 <> 9 THEN CASE WHEN k % 2 = 0 THEN 'M' ELSE 'F' END END AS birth_sex,
  CASE WHEN k % 10 <> 9 THEN 'Maiden' || CAST(k % 100 AS VARCHAR) END AS mothers_maiden_name,
  CASE WHEN k % 10 <> 9 THEN n_name END AS birth_city,
  CASE WHEN k % 10 <> 9 THEN r_name END AS birth_state,
  CASE WHEN k % 7 = 0 THEN CAST(k % 3 + 1 AS INTEGER) END AS multiple_birth_order,
  CASE WHEN k % 10 <> 9 THEN CAST(k % 70 AS DOUBLE) / 4.0 END AS quality_adjusted_life_years,
  CASE WHEN k % 10 <> 9 THEN CAST(k % 40 AS DOUBLE) / 8.0 END AS disability_adjusted_life_years,
  CASE WHEN k % {RESEND} = 0 THEN 'raw/fhir/resend/patient/pat-' ELSE 'raw/fhir/patient/pat-' END
    || CAST(k AS VARCHAR) || '.json' AS file_path,
  CASE WHEN k % {RESEND} = 0 THEN TIMESTAMP '2024-03-01 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS ingestion_timestamp,
  CASE WHEN k % {RESEND} = 0 THEN TIMESTAMP '2024-03-01 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS ingested_at
FROM (SELECT c.c_custkey AS k, c.c_name, c.c_mktsegment, n.n_name, r.r_name
      FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
      LEFT JOIN region r ON n.n_regionkey = r.r_regionkey) src
"""

# one row per order with the visit-bundle file and load time that wins
_VISIT = f"""
SELECT o_orderkey AS o, o_custkey AS c, o_orderdate AS od, CAST(o_orderdate AS DATE) AS d,
  CAST(o_orderkey AS VARCHAR) AS os,
  CASE WHEN o_custkey % {RESEND} = 0 THEN 'raw/fhir/resend/visit/enc-' ELSE 'raw/fhir/visit/enc-' END
    || CAST(o_orderkey AS VARCHAR) || '.json' AS file_path,
  CASE WHEN o_custkey % {RESEND} = 0 THEN TIMESTAMP '2024-03-01 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS ts_load
FROM orders
"""

STG_ENCOUNTERS = f"""
SELECT 'enc-' || os AS encounter_id, 'pat-' || CAST(c AS VARCHAR) AS patient_id,
  CASE WHEN c % {RESEND} = 0 THEN 'amended' ELSE 'finished' END AS status,
  ['AMB','EMER','IMP'][o % 3 + 1] AS class,
  'Encounter type ' || CAST(o % 5 AS VARCHAR) AS encounter_type,
  CASE WHEN o % 40 <> 17 THEN d END AS start_time, d + CAST(o % 4 AS INTEGER) AS end_time,
  'prac-' || CAST(o % 50 AS VARCHAR) AS provider_id,
  file_path, ts_load AS ingestion_timestamp, ts_load AS ingested_at
FROM ({_VISIT}) v
"""

STG_CONDITIONS = f"""
SELECT 'cond-' || os AS condition_id, 'pat-' || CAST(c AS VARCHAR) AS patient_id, 'enc-' || os AS encounter_id,
  CASE WHEN o % 2 = 0 THEN 'resolved' ELSE 'active' END AS clinical_status,
  'confirmed' AS verification_status,
  'C' || CAST(o * 31 % 23 AS VARCHAR) AS condition_code,
  'Cond ' || CAST(o * 31 % 23 AS VARCHAR) AS condition_description,
  d AS onset_date,
  CASE WHEN o % 2 = 0 THEN d + CAST(o % 90 AS INTEGER) END AS abatement_date,
  file_path, ts_load AS ingestion_timestamp, ts_load AS ingested_at
FROM ({_VISIT}) v WHERE o % 3 = 0
"""

STG_PROCEDURES = f"""
SELECT 'proc-' || os AS procedure_id, 'pat-' || CAST(c AS VARCHAR) AS patient_id, 'enc-' || os AS encounter_id,
  'completed' AS status,
  'P' || CAST(o % 12 AS VARCHAR) AS procedure_code, 'Proc ' || CAST(o % 12 AS VARCHAR) AS procedure_description,
  d AS start_date, CASE WHEN o % 8 <> 1 THEN d + CAST(o % 3 AS INTEGER) END AS end_date,
  file_path, ts_load AS ingestion_timestamp, ts_load AS ingested_at
FROM ({_VISIT}) v WHERE o % 4 = 1
"""

STG_MEDICATION_REQUESTS = f"""
SELECT 'med-' || os AS medication_request_id, 'pat-' || CAST(c AS VARCHAR) AS patient_id, 'enc-' || os AS encounter_id,
  'Practitioner?identifier=' || CAST(o % 5 AS VARCHAR) AS requester_id,
  CASE WHEN o % 2 = 0 THEN 'active' ELSE 'stopped' END AS status,
  'order' AS intent,
  'M' || CAST(pk % 17 AS VARCHAR) AS medication_code, 'Med ' || CAST(pk % 17 AS VARCHAR) AS medication_description,
  od + INTERVAL 28 HOUR + INTERVAL 30 MINUTE AS authored_date,
  file_path, ts_load AS ingestion_timestamp, ts_load AS ingested_at
FROM ({_VISIT}) v JOIN (SELECT l_orderkey, min(l_partkey) AS pk FROM lineitem GROUP BY l_orderkey) li
  ON v.o = li.l_orderkey
"""

STG_IMMUNIZATIONS = f"""
SELECT 'imm-' || os AS immunization_id, 'pat-' || CAST(c AS VARCHAR) AS patient_id, 'enc-' || os AS encounter_id,
  'completed' AS status,
  'V' || CAST(o % 9 AS VARCHAR) AS vaccine_code, 'Vac ' || CAST(o % 9 AS VARCHAR) AS vaccine_description,
  od + INTERVAL 12 HOUR AS occurrence_date,
  file_path, ts_load AS ingestion_timestamp, ts_load AS ingested_at
FROM ({_VISIT}) v WHERE o % 7 = 0
"""

STG_OBSERVATIONS = f"""
SELECT 'obs-' || CAST(event_id AS VARCHAR) AS observation_id,
  CASE WHEN event_id % 50 = 7 THEN 'ghost-' || CAST(event_id AS VARCHAR) ELSE 'pat-' || CAST(user_id AS VARCHAR) END AS patient_id,
  CAST(NULL AS VARCHAR) AS encounter_id,
  'final' AS status, 'vital-signs' AS category,
  event_type AS observation_code, 'Obs ' || event_type AS observation_description,
  CASE WHEN event_id % 10 = 3 THEN NULL
       WHEN user_id % {RESEND} = 0 THEN value + 1.0 ELSE value END AS value_quantity,
  CASE WHEN event_id % 10 = 3 THEN NULL WHEN event_id % 3 <> 0 THEN 'mmHg' ELSE 'kg' END AS value_unit,
  ts AS effective_date,
  CASE WHEN user_id % {RESEND} = 0 THEN 'raw/fhir/resend/obs/obs-' ELSE 'raw/fhir/obs/obs-' END
    || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') || '-' || CAST(event_id // 1000 AS VARCHAR) || '.json' AS file_path,
  CASE WHEN user_id % {RESEND} = 0 THEN TIMESTAMP '2024-03-01 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS ingestion_timestamp,
  CASE WHEN user_id % {RESEND} = 0 THEN TIMESTAMP '2024-03-01 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS ingested_at
FROM events
"""

# no dedup: customers with k % 30 = 0 appear once per load
STG_ALLERGY_INTOLERANCES = f"""
SELECT 'alg-' || CAST(k AS VARCHAR) AS allergy_id, 'pat-' || CAST(k AS VARCHAR) AS patient_id,
  'active' AS clinical_status, 'confirmed' AS verification_status,
  CASE WHEN k % 4 = 0 THEN 'allergy' ELSE 'intolerance' END AS allergy_type,
  ['food','environment','medication'][(k % 9) // 3 + 1] AS category,
  CASE WHEN k % 12 = 0 THEN 'high' ELSE 'low' END AS criticality,
  'A' || CAST(k % 8 AS VARCHAR) AS allergy_code, 'Alg ' || CAST(k % 8 AS VARCHAR) AS allergy_description,
  TIMESTAMP '2010-01-01 00:00:00' AS recorded_date,
  CASE WHEN n = 2 THEN 'raw/fhir/resend/patient/pat-' ELSE 'raw/fhir/patient/pat-' END || CAST(k AS VARCHAR) || '.json' AS file_path,
  CASE WHEN n = 2 THEN TIMESTAMP '2024-03-01 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS ingestion_timestamp,
  CASE WHEN n = 2 THEN TIMESTAMP '2024-03-01 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS ingested_at
FROM (SELECT c_custkey AS k FROM customer) c CROSS JOIN (VALUES (1), (2)) l(n)
WHERE k % 6 = 0 AND (n = 1 OR k % {RESEND} = 0)
"""

STAGING = {
    "stg_patients": STG_PATIENTS,
    "stg_encounters": STG_ENCOUNTERS,
    "stg_conditions": STG_CONDITIONS,
    "stg_observations": STG_OBSERVATIONS,
    "stg_medication_requests": STG_MEDICATION_REQUESTS,
    "stg_procedures": STG_PROCEDURES,
    "stg_immunizations": STG_IMMUNIZATIONS,
    "stg_allergy_intolerances": STG_ALLERGY_INTOLERANCES,
}


def with_staging(body: str, *models: str) -> str:
    ctes = ",\n".join(f"{m} AS ({STAGING[m]})" for m in models)
    return f"WITH {ctes}\n{body}"


AS_OF_DATE_TEXT = "2024-12-31"
AS_OF = f"DATE '{AS_OF_DATE_TEXT}'"

# Marts, from the fixture rules over the base tables.  A patient is a row of
# ``customer`` (k); what a fact shows of it is computed here from k, not
# taken from the staging expectation.
_WHO = f"""
SELECT 'pat-' || CAST(k AS VARCHAR) AS who, k, {BIRTH} AS born,
  CASE k % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN 'other' ELSE 'unknown' END AS sex,
  CASE WHEN k % 10 = 9 THEN NULL WHEN k % 4 = 0 THEN 'White' WHEN k % 4 = 1 THEN 'Black' WHEN k % 4 = 2 THEN 'Asian' ELSE 'Other' END AS origin,
  CASE WHEN k % 10 = 9 THEN NULL WHEN k % 6 = 0 THEN 'Hispanic or Latino' ELSE 'Not Hispanic or Latino' END AS latin,
  concat(n_name, CASE WHEN k % {RESEND} = 0 THEN '-moved' END) AS town, r_name AS area
FROM (SELECT c_custkey AS k, c_nationkey FROM customer) c
  LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
"""


def _age(day: str) -> str:
    return f"date_sub('year', born, {day})"


def _fact(source: str, columns: dict[str, str]) -> str:
    """Facts of ``source`` with whom they are about; ``columns``: name -> rule."""
    return (f"SELECT {', '.join(f'{rule} AS {name}' for name, rule in columns.items())} "
            f"FROM ({source}) f LEFT JOIN ({_WHO}) w ON f.patient_id = w.who")


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


DIM_PATIENTS_BODY = f"""
WITH visits AS (SELECT o_custkey AS k, count(*) AS n, CAST(min(o_orderdate) FILTER (o_orderkey % 40 <> 17) AS DATE) AS lo,
  CAST(max(o_orderdate) FILTER (o_orderkey % 40 <> 17) AS DATE) AS hi FROM orders GROUP BY 1),
w AS ({_WHO})
SELECT who AS patient_id, c_mktsegment AS given_name, c_name AS family_name, sex AS gender, born AS birth_date,
  concat(w.k, ' Main St') AS address_line, town AS city, area AS state, format('{{:05d}}', w.k % 100000) AS postal_code, 'US' AS country,
  format('555-{{:04d}}', w.k % 10000) AS phone_number,
  CASE w.k % 5 WHEN 0 THEN 'English' WHEN 1 THEN 'Spanish' WHEN 2 THEN 'French' WHEN 3 THEN 'German' ELSE 'Chinese' END AS primary_language,
  origin AS race, latin AS ethnicity,
  CASE w.k % 3 WHEN 0 THEN 'Married' WHEN 1 THEN 'Never Married' ELSE 'Divorced' END AS marital_status,
  lo AS first_encounter_date, hi AS last_encounter_date, ifnull(n, 0) AS total_encounters,
  {_age(AS_OF)} AS age_years, CAST(if(w.k % {RESEND} = 0, '2024-03-01', '2024-02-01') AS TIMESTAMP) AS ingested_at
FROM w JOIN customer ON c_custkey = w.k LEFT JOIN visits v ON v.k = w.k
"""

_VISIT_KEYS = {"patient_id": "patient_id", "encounter_id": "encounter_id"}

FCT_ENCOUNTERS_BODY = _fact(STG_ENCOUNTERS, {
    **_same("encounter_id", "patient_id"), "encounter_status": "status", "encounter_class": '"class"',
    **_same("encounter_type", "start_time", "end_time", "provider_id"), "duration_days": "end_time - start_time",
    "patient_gender": "sex", "patient_birth_date": "born", "patient_city": "town", "patient_state": "area", "patient_race": "origin",
    "patient_ethnicity": "latin", "patient_age_at_encounter": _age("start_time"), "ingested_at": "ingested_at"})

FCT_CONDITIONS_BODY = _fact(STG_CONDITIONS, {
    "condition_id": "condition_id", **_VISIT_KEYS,
    **_same("clinical_status", "verification_status", "condition_code", "condition_description", "onset_date", "abatement_date"),
    "patient_gender": "sex", "patient_race": "origin", "patient_age_at_onset": _age("onset_date"),
    "condition_lifecycle_status": "if(clinical_status = 'resolved', 'Resolved', 'Active')", "ingested_at": "ingested_at"})

FCT_MEDICATIONS_BODY = _fact(STG_MEDICATION_REQUESTS, {
    "medication_request_id": "medication_request_id", **_VISIT_KEYS, "medication_status": "status", "medication_intent": "'order'",
    **_same("medication_code", "medication_description", "authored_date"),
    "patient_gender": "sex", "patient_race": "origin", "patient_age_at_request": _age("CAST(authored_date AS DATE)"),
    "ingested_at": "ingested_at"})

FCT_PROCEDURES_BODY = _fact(STG_PROCEDURES, {
    "procedure_id": "procedure_id", **_VISIT_KEYS, "procedure_status": "'completed'",
    **_same("procedure_code", "procedure_description", "start_date", "end_date"),
    "duration_minutes": "24 * 60 * ifnull(end_date - start_date, 0)",
    "patient_gender": "sex", "patient_race": "origin", "patient_age_at_procedure": _age("start_date"), "ingested_at": "ingested_at"})

FCT_IMMUNIZATIONS_BODY = _fact(STG_IMMUNIZATIONS, {
    "immunization_id": "immunization_id", **_VISIT_KEYS, "immunization_status": "'completed'",
    **_same("vaccine_code", "vaccine_description", "occurrence_date"),
    "patient_gender": "sex", "patient_race": "origin", "patient_age_at_immunization": _age("CAST(occurrence_date AS DATE)"),
    "ingested_at": "ingested_at"})

FCT_VITALS_BODY = _fact(STG_OBSERVATIONS, {
    "observation_id": "observation_id", **_VISIT_KEYS,
    **_same("category", "observation_code", "observation_description", "value_quantity", "value_unit", "effective_date"),
    "patient_gender": "sex", "patient_race": "origin", "patient_ethnicity": "latin",
    "patient_age_at_observation": _age("CAST(effective_date AS DATE)"), "ingested_at": "ingested_at"})

MARTS = {
    "dim_patients": DIM_PATIENTS_BODY,
    "fct_encounters": FCT_ENCOUNTERS_BODY,
    "fct_conditions": FCT_CONDITIONS_BODY,
    "fct_medications": FCT_MEDICATIONS_BODY,
    "fct_procedures": FCT_PROCEDURES_BODY,
    "fct_immunizations": FCT_IMMUNIZATIONS_BODY,
    "fct_vitals": FCT_VITALS_BODY,
}


def with_marts(body: str, *marts: str) -> str:
    """``WITH <mart ctes> <body>``."""
    return "WITH " + ",\n".join(f"{m} AS ({MARTS[m]})" for m in marts) + "\n" + body


def staging_sql(model: str) -> str:
    return with_staging(f"SELECT * FROM {model}", model)


def mart_sql(mart: str) -> str:
    return with_marts(f"SELECT * FROM {mart}", mart)


# --- entries (before dedup) --------------------------------------------------

BUNDLE_ENTRIES = f"""
WITH loads AS (SELECT 1 AS l, TIMESTAMP '2024-02-01 00:00:00' AS lts, '' AS rs
               UNION ALL SELECT 2, TIMESTAMP '2024-03-01 00:00:00', 'resend/'),
pat AS (SELECT c_custkey AS k FROM customer),
vis AS (SELECT o_orderkey AS o, o_custkey AS c, pk FROM orders
        LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS pk FROM lineitem GROUP BY l_orderkey) li ON o_orderkey = l_orderkey),
ev AS (SELECT event_id AS e, user_id AS u, ts FROM events),
pb AS (SELECT k, lts, 'raw/fhir/' || rs || 'patient/pat-' || CAST(k AS VARCHAR) || '.json' AS fp
       FROM pat, loads WHERE l = 1 OR k % {RESEND} = 0),
vb AS (SELECT o, pk, lts, 'raw/fhir/' || rs || 'visit/enc-' || CAST(o AS VARCHAR) || '.json' AS fp,
              CAST(o % 3 = 0 AS INTEGER) AS hc, CAST(o % 4 = 1 AS INTEGER) AS hp, CAST(pk IS NOT NULL AS INTEGER) AS hm
       FROM vis, loads WHERE l = 1 OR c % {RESEND} = 0),
ob AS (SELECT e, lts, 'raw/fhir/' || rs || 'obs/obs-' || CAST(u AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') || '-'
              || CAST(e // 1000 AS VARCHAR) || '.json' AS fp
       FROM ev, loads WHERE l = 1 OR u % {RESEND} = 0)
SELECT fp AS file_path, lts AS ingestion_timestamp, 0 AS pos, 'Patient' AS resource_type, 'pat-' || CAST(k AS VARCHAR) AS resource_id FROM pb
UNION ALL SELECT fp, lts, 1, 'AllergyIntolerance', 'alg-' || CAST(k AS VARCHAR) FROM pb WHERE k % 6 = 0
UNION ALL SELECT fp, lts, 0, 'Encounter', 'enc-' || CAST(o AS VARCHAR) FROM vb
UNION ALL SELECT fp, lts, 1, 'Condition', 'cond-' || CAST(o AS VARCHAR) FROM vb WHERE hc = 1
UNION ALL SELECT fp, lts, 1 + hc, 'Procedure', 'proc-' || CAST(o AS VARCHAR) FROM vb WHERE hp = 1
UNION ALL SELECT fp, lts, 1 + hc + hp, 'MedicationRequest', 'med-' || CAST(o AS VARCHAR) FROM vb WHERE hm = 1
UNION ALL SELECT fp, lts, 1 + hc + hp + hm, 'Immunization', 'imm-' || CAST(o AS VARCHAR) FROM vb WHERE o % 7 = 0
UNION ALL SELECT fp, lts, CAST(row_number() OVER (PARTITION BY fp ORDER BY e) - 1 AS INTEGER), 'Observation',
                 'obs-' || CAST(e AS VARCHAR) FROM ob
"""

# --- raw-file manifest from documents ----------------------------------------

DOC_MANIFEST = """
SELECT 'raw/' || source || '/' || CAST(doc_id AS VARCHAR) || CASE WHEN doc_id % 10 = 0 THEN '.txt' ELSE '.json' END AS path,
       CAST(strlen(text) + CASE WHEN doc_id % 17 = 5 THEN 1 ELSE 0 END AS BIGINT) AS length, CAST(length(text) AS INTEGER) AS n_chars, doc_id
FROM documents
"""
DOC_JSON = f"SELECT * FROM ({DOC_MANIFEST}) m WHERE path LIKE '%.json'"
# files whose bytes are not UTF-8
DOC_BAD = "doc_id % 17 = 5"
DOC_PENDING = f"SELECT * FROM ({DOC_JSON}) j WHERE doc_id NOT IN (SELECT doc_id FROM labels)"


def audit_sql(checks) -> str:
    """One SELECT per declared test over the oracle CTEs, unioned."""
    clock = {"dbt_processed_at", "dbt_updated_at"}
    parts = []
    for c in checks:
        head = f"SELECT '{c.model}' AS model, '{c.test}' AS test, '{c.column}' AS \"column\""
        if c.column in clock:
            parts.append(f"{head}, CAST(0 AS BIGINT) AS violations")
        elif c.test == "unique":
            parts.append(f"{head}, CAST(count(*) AS BIGINT) AS violations FROM (SELECT {c.column} FROM {c.model} "
                         f"WHERE {c.column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1) t")
        elif c.test == "not_null":
            parts.append(f"{head}, CAST(count(*) AS BIGINT) AS violations FROM {c.model} WHERE {c.column} IS NULL")
        elif c.test == "accepted_values":
            vals = ", ".join(f"'{v}'" for v in c.values)
            parts.append(f"{head}, CAST(count(*) AS BIGINT) AS violations FROM {c.model} "
                         f"WHERE {c.column} IS NOT NULL AND {c.column} NOT IN ({vals})")
        elif c.test == "relationships":
            parts.append(f"{head}, CAST(count(*) AS BIGINT) AS violations FROM {c.model} x WHERE x.{c.column} IS NOT NULL "
                         f"AND NOT EXISTS (SELECT 1 FROM {c.to} y WHERE y.{c.to_field} = x.{c.column})")
    return "\nUNION ALL\n".join(parts)


def with_all(body: str) -> str:
    ctes = [f"{m} AS ({STAGING[m]})" for m in STAGING]
    ctes += [f"{m} AS ({MARTS[m]})" for m in MARTS]
    return "WITH " + ",\n".join(ctes) + "\n" + body
