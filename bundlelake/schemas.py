"""Fixed table shapes and the per-resource flattening specs."""

from __future__ import annotations

from pyspark.sql import types as T

LANDING_SCHEMA = T.StructType([
    T.StructField("file_path", T.StringType()),
    T.StructField("data", T.StringType()),
    T.StructField("ingestion_timestamp", T.TimestampType()),
])

ENTRIES_COLUMNS = ["file_path", "ingestion_timestamp", "pos", "resource_type", "entry"]

# Extraction kinds used by the staging specs:
#   str    json_extract_scalar
#   ref    json_extract_scalar + strip 'urn:uuid:'
#   date   CAST(text AS DATE)
#   date10 CAST(SUBSTR(text, 1, 10) AS DATE)
#   ts     ISO-8601 text -> instant
#   double / int   strict numeric casts
#
# The JSON paths, column names and resource types below are
# the reference's staging contract (one spec per staging model, in the
# model's column order).  Paths are relative to one bundle entry.
STAGING_SPECS = {
    "stg_patients": {
        "resource_type": "Patient",
        "key": "patient_id",
        "dedup": True,
        "columns": [
            ("patient_id", "$.resource.id", "str"),
            ("patient_full_url", "$.fullUrl", "str"),
            ("gender", "$.resource.gender", "str"),
            ("birth_date", "$.resource.birthDate", "date"),
            ("family_name", "$.resource.name[0].family", "str"),
            ("given_name", "$.resource.name[0].given[0]", "str"),
            ("middle_name", "$.resource.name[0].given[1]", "str"),
            ("address_line", "$.resource.address[0].line[0]", "str"),
            ("city", "$.resource.address[0].city", "str"),
            ("state", "$.resource.address[0].state", "str"),
            ("postal_code", "$.resource.address[0].postalCode", "str"),
            ("country", "$.resource.address[0].country", "str"),
            ("latitude", "$.resource.address[0].extension[0].extension[0].valueDecimal", "double"),
            ("longitude", "$.resource.address[0].extension[0].extension[1].valueDecimal", "double"),
            ("phone_number", "$.resource.telecom[0].value", "str"),
            ("marital_status", "$.resource.maritalStatus.text", "str"),
            ("primary_language", "$.resource.communication[0].language.text", "str"),
            ("race", "$.resource.extension[0].extension[1].valueString", "str"),
            ("ethnicity", "$.resource.extension[1].extension[1].valueString", "str"),
            ("birth_sex", "$.resource.extension[3].valueCode", "str"),
            ("mothers_maiden_name", "$.resource.extension[2].valueString", "str"),
            ("birth_city", "$.resource.extension[4].valueAddress.city", "str"),
            ("birth_state", "$.resource.extension[4].valueAddress.state", "str"),
            ("multiple_birth_order", "$.resource.multipleBirthInteger", "int"),
            ("quality_adjusted_life_years", "$.resource.extension[6].valueDecimal", "double"),
            ("disability_adjusted_life_years", "$.resource.extension[5].valueDecimal", "double"),
        ],
    },
    "stg_encounters": {
        "resource_type": "Encounter",
        "key": "encounter_id",
        "dedup": True,
        "columns": [
            ("encounter_id", "$.resource.id", "str"),
            ("patient_id", "$.resource.subject.reference", "ref"),
            ("status", "$.resource.status", "str"),
            ("class", "$.resource.class.code", "str"),
            ("encounter_type", "$.resource.type[0].coding[0].display", "str"),
            ("start_time", "$.resource.period.start", "date10"),
            ("end_time", "$.resource.period.end", "date10"),
            ("provider_id", "$.resource.participant[0].individual.reference", "ref"),
        ],
    },
    "stg_conditions": {
        "resource_type": "Condition",
        "key": "condition_id",
        "dedup": True,
        "columns": [
            ("condition_id", "$.resource.id", "str"),
            ("patient_id", "$.resource.subject.reference", "ref"),
            ("encounter_id", "$.resource.encounter.reference", "ref"),
            ("clinical_status", "$.resource.clinicalStatus.coding[0].code", "str"),
            ("verification_status", "$.resource.verificationStatus.coding[0].code", "str"),
            ("condition_code", "$.resource.code.coding[0].code", "str"),
            ("condition_description", "$.resource.code.coding[0].display", "str"),
            ("onset_date", "$.resource.onsetDateTime", "date10"),
            ("abatement_date", "$.resource.abatementDateTime", "date10"),
        ],
    },
    "stg_observations": {
        "resource_type": "Observation",
        "key": "observation_id",
        "dedup": True,
        "columns": [
            ("observation_id", "$.resource.id", "str"),
            ("patient_id", "$.resource.subject.reference", "ref"),
            ("encounter_id", "$.resource.encounter.reference", "ref"),
            ("status", "$.resource.status", "str"),
            ("category", "$.resource.category[0].coding[0].code", "str"),
            ("observation_code", "$.resource.code.coding[0].code", "str"),
            ("observation_description", "$.resource.code.coding[0].display", "str"),
            ("value_quantity", "$.resource.valueQuantity.value", "double"),
            ("value_unit", "$.resource.valueQuantity.unit", "str"),
            ("effective_date", "$.resource.effectiveDateTime", "ts"),
        ],
    },
    "stg_medication_requests": {
        "resource_type": "MedicationRequest",
        "key": "medication_request_id",
        "dedup": True,
        "columns": [
            ("medication_request_id", "$.resource.id", "str"),
            ("patient_id", "$.resource.subject.reference", "ref"),
            ("encounter_id", "$.resource.encounter.reference", "ref"),
            ("requester_id", "$.resource.requester.reference", "ref"),
            ("status", "$.resource.status", "str"),
            ("intent", "$.resource.intent", "str"),
            ("medication_code", "$.resource.medicationCodeableConcept.coding[0].code", "str"),
            ("medication_description", "$.resource.medicationCodeableConcept.coding[0].display", "str"),
            ("authored_date", "$.resource.authoredOn", "ts"),
        ],
    },
    "stg_procedures": {
        "resource_type": "Procedure",
        "key": "procedure_id",
        "dedup": True,
        "columns": [
            ("procedure_id", "$.resource.id", "str"),
            ("patient_id", "$.resource.subject.reference", "ref"),
            ("encounter_id", "$.resource.encounter.reference", "ref"),
            ("status", "$.resource.status", "str"),
            ("procedure_code", "$.resource.code.coding[0].code", "str"),
            ("procedure_description", "$.resource.code.coding[0].display", "str"),
            ("start_date", "$.resource.performedPeriod.start", "date10"),
            ("end_date", "$.resource.performedPeriod.end", "date10"),
        ],
    },
    "stg_immunizations": {
        "resource_type": "Immunization",
        "key": "immunization_id",
        "dedup": True,
        "columns": [
            ("immunization_id", "$.resource.id", "str"),
            ("patient_id", "$.resource.patient.reference", "ref"),
            ("encounter_id", "$.resource.encounter.reference", "ref"),
            ("status", "$.resource.status", "str"),
            ("vaccine_code", "$.resource.vaccineCode.coding[0].code", "str"),
            ("vaccine_description", "$.resource.vaccineCode.coding[0].display", "str"),
            ("occurrence_date", "$.resource.occurrenceDateTime", "ts"),
        ],
    },
    "stg_allergy_intolerances": {
        "resource_type": "AllergyIntolerance",
        "key": "allergy_id",
        "dedup": False,  # the reference model keeps every copy
        "columns": [
            ("allergy_id", "$.resource.id", "str"),
            ("patient_id", "$.resource.patient.reference", "ref"),
            ("clinical_status", "$.resource.clinicalStatus.coding[0].code", "str"),
            ("verification_status", "$.resource.verificationStatus.coding[0].code", "str"),
            ("allergy_type", "$.resource.type", "str"),
            ("category", "$.resource.category[0]", "str"),
            ("criticality", "$.resource.criticality", "str"),
            ("allergy_code", "$.resource.code.coding[0].code", "str"),
            ("allergy_description", "$.resource.code.coding[0].display", "str"),
            ("recorded_date", "$.resource.recordedDate", "ts"),
        ],
    },
}

RESOURCE_TYPES = [s["resource_type"] for s in STAGING_SPECS.values()]

# Fixed value: accepted values of the gender test.
ACCEPTED_GENDERS = ["male", "female", "other", "unknown"]


# kind of a staging column -> its type
COLUMN_TYPES = {"str": "string", "ref": "string", "date": "date", "date10": "date", "ts": "timestamp", "double": "double", "int": "int"}


def typed_schema() -> str:
    """Columns of the typed-entries table: one struct per staging model."""
    models = [f"{m} struct<" + ", ".join(f"`{n}`: {COLUMN_TYPES[k]}" for n, _, k in s["columns"]) + ">" for m, s in STAGING_SPECS.items()]
    return "file_path string, ingestion_timestamp timestamp, pos int, resource_type string, " + ", ".join(models)
