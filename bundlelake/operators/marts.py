"""Patient dimension and the six clinical facts.

Each fact is ``stg_x LEFT JOIN stg_patients USING (patient_id)`` plus a
few derived columns.  No join hint is forced: patients can be as large as
the facts at scale, so the join strategy is left to AQE, which broadcasts
only when the measured patient side is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges,
splitting a skewed patient key on the (left, preserved) fact side.
Only the patient columns a fact needs are projected before the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bundlelake.functions.json import age_in_years


def _as_of(as_of_date) -> Column:
    if as_of_date is None:
        return F.current_date()
    return F.lit(str(as_of_date)).cast("date")


def age_at(birth: Column, as_of_date) -> Column:
    return age_in_years(birth, _as_of(as_of_date))


def _updated_at(updated_at: Column | None) -> Column:
    return (updated_at if updated_at is not None else F.current_timestamp()).alias("dbt_updated_at")


def enrich(fact: DataFrame, patients: DataFrame, columns: list[str]) -> DataFrame:
    """Left-join the needed patient columns (prefixed ``p_``) onto a fact."""
    p = patients.select(F.col("patient_id").alias("_pid"), *[F.col(c).alias("p_" + c) for c in columns])
    return fact.join(p, fact["patient_id"] == p["_pid"], "left").drop("_pid")


def patient_encounter_stats(encounters: DataFrame) -> DataFrame:
    """MIN/MAX start and COUNT(*) of encounters per patient (partial
    aggregation runs before the shuffle, so a hot patient costs one row
    per map task in the exchange)."""
    return encounters.groupBy("patient_id").agg(
        F.min("start_time").alias("first_encounter_date"),
        F.max("start_time").alias("last_encounter_date"),
        F.count(F.lit(1)).alias("total_encounters"))


def dim_patients(patients: DataFrame, encounters: DataFrame | None, as_of_date=None,
                 updated_at: Column | None = None, stats: DataFrame | None = None) -> DataFrame:
    """``stats``: the patients' encounter stats, where they are at hand."""
    stats = (patient_encounter_stats(encounters) if stats is None else stats).withColumnRenamed("patient_id", "_pid")
    p = patients
    j = p.join(stats, p["patient_id"] == stats["_pid"], "left")
    return j.select(
        "patient_id", "given_name", "family_name", "gender", "birth_date", "address_line",
        "city", "state", "postal_code", "country", "phone_number", "primary_language", "race",
        "ethnicity", "marital_status", "first_encounter_date", "last_encounter_date",
        F.coalesce(F.col("total_encounters"), F.lit(0).cast("long")).alias("total_encounters"),
        age_at(F.col("birth_date"), as_of_date).alias("age_years"),
        "ingested_at", _updated_at(updated_at))


def fct_encounters(encounters: DataFrame, patients: DataFrame, updated_at: Column | None = None) -> DataFrame:
    j = enrich(encounters, patients, ["gender", "birth_date", "city", "state", "race", "ethnicity"])
    return j.select(
        "encounter_id", "patient_id",
        F.col("status").alias("encounter_status"),
        F.col("class").alias("encounter_class"),
        "encounter_type", "start_time", "end_time", "provider_id",
        F.datediff("end_time", "start_time").cast("long").alias("duration_days"),
        F.col("p_gender").alias("patient_gender"),
        F.col("p_birth_date").alias("patient_birth_date"),
        F.col("p_city").alias("patient_city"),
        F.col("p_state").alias("patient_state"),
        F.col("p_race").alias("patient_race"),
        F.col("p_ethnicity").alias("patient_ethnicity"),
        age_in_years(F.col("p_birth_date"), F.col("start_time").cast("date")).alias("patient_age_at_encounter"),
        "ingested_at", _updated_at(updated_at))


def fct_conditions(conditions: DataFrame, patients: DataFrame, updated_at: Column | None = None) -> DataFrame:
    j = enrich(conditions, patients, ["gender", "race", "birth_date"])
    return j.select(
        "condition_id", "patient_id", "encounter_id", "clinical_status", "verification_status",
        "condition_code", "condition_description", "onset_date", "abatement_date",
        F.col("p_gender").alias("patient_gender"),
        F.col("p_race").alias("patient_race"),
        age_in_years(F.col("p_birth_date"), F.col("onset_date")).alias("patient_age_at_onset"),
        F.when(F.col("abatement_date").isNull(), F.lit("Active")).otherwise(F.lit("Resolved"))
         .alias("condition_lifecycle_status"),
        "ingested_at", _updated_at(updated_at))


def fct_medications(medications: DataFrame, patients: DataFrame, updated_at: Column | None = None) -> DataFrame:
    j = enrich(medications, patients, ["gender", "race", "ethnicity", "birth_date"])
    return j.select(
        "medication_request_id", "patient_id", "encounter_id",
        F.col("status").alias("medication_status"),
        F.col("intent").alias("medication_intent"),
        "medication_code", "medication_description", "authored_date",
        F.col("p_gender").alias("patient_gender"),
        F.col("p_race").alias("patient_race"),
        age_in_years(F.col("p_birth_date"), F.col("authored_date").cast("date")).alias("patient_age_at_request"),
        "ingested_at", _updated_at(updated_at))


def fct_procedures(procedures: DataFrame, patients: DataFrame, updated_at: Column | None = None) -> DataFrame:
    j = enrich(procedures, patients, ["gender", "race", "birth_date"])
    start = F.col("start_date").cast("timestamp")
    end = F.coalesce(F.col("end_date"), F.col("start_date")).cast("timestamp")
    return j.select(
        "procedure_id", "patient_id", "encounter_id",
        F.col("status").alias("procedure_status"),
        "procedure_code", "procedure_description", "start_date", "end_date",
        F.timestamp_diff("MINUTE", start, end).alias("duration_minutes"),
        F.col("p_gender").alias("patient_gender"),
        F.col("p_race").alias("patient_race"),
        age_in_years(F.col("p_birth_date"), F.col("start_date")).alias("patient_age_at_procedure"),
        "ingested_at", _updated_at(updated_at))


def fct_immunizations(immunizations: DataFrame, patients: DataFrame, updated_at: Column | None = None) -> DataFrame:
    j = enrich(immunizations, patients, ["gender", "race", "birth_date"])
    return j.select(
        "immunization_id", "patient_id", "encounter_id",
        F.col("status").alias("immunization_status"),
        "vaccine_code", "vaccine_description", "occurrence_date",
        F.col("p_gender").alias("patient_gender"),
        F.col("p_race").alias("patient_race"),
        age_in_years(F.col("p_birth_date"), F.col("occurrence_date").cast("date")).alias("patient_age_at_immunization"),
        "ingested_at", _updated_at(updated_at))


def fct_vitals(observations: DataFrame, patients: DataFrame, updated_at: Column | None = None) -> DataFrame:
    j = enrich(observations, patients, ["gender", "race", "ethnicity", "birth_date"])
    return j.select(
        "observation_id", "patient_id", "encounter_id", "category", "observation_code",
        "observation_description", "value_quantity", "value_unit", "effective_date",
        F.col("p_gender").alias("patient_gender"),
        F.col("p_race").alias("patient_race"),
        F.col("p_ethnicity").alias("patient_ethnicity"),
        age_in_years(F.col("p_birth_date"), F.col("effective_date").cast("date")).alias("patient_age_at_observation"),
        "ingested_at", _updated_at(updated_at))


# mart name -> (builder, staging model of the fact side)
FACTS = {
    "fct_encounters": (fct_encounters, "stg_encounters"),
    "fct_conditions": (fct_conditions, "stg_conditions"),
    "fct_medications": (fct_medications, "stg_medication_requests"),
    "fct_procedures": (fct_procedures, "stg_procedures"),
    "fct_immunizations": (fct_immunizations, "stg_immunizations"),
    "fct_vitals": (fct_vitals, "stg_observations"),
}

MART_KEYS = {
    "dim_patients": "patient_id",
    "fct_encounters": "encounter_id",
    "fct_conditions": "condition_id",
    "fct_medications": "medication_request_id",
    "fct_procedures": "procedure_id",
    "fct_immunizations": "immunization_id",
    "fct_vitals": "observation_id",
}


def sources(mart: str) -> set[str]:
    """The staging models a mart reads."""
    return {"stg_patients", "stg_encounters" if mart == "dim_patients" else FACTS[mart][1]}


def build_mart(name: str, staging: dict[str, DataFrame], as_of_date=None) -> DataFrame:
    """One mart from its ``sources``."""
    patients = staging["stg_patients"]
    if name == "dim_patients":
        return dim_patients(patients, staging["stg_encounters"], as_of_date)
    fn, src = FACTS[name]
    return fn(staging[src], patients)


def build_marts(staging: dict[str, DataFrame], as_of_date=None) -> dict[str, DataFrame]:
    return {m: build_mart(m, staging, as_of_date) for m in MART_KEYS}
