"""Bundle fixtures generated by Spark from the driver's tables.

The reference ships no data; its input is FHIR bundles.  These jobs
derive deterministic bundles from ``customer``, ``nation``, ``region``,
``orders``, ``lineitem`` and ``events`` so that every staging, mart and
serving result can be recomputed independently (no JSON) by SQL over the
same tables.

Bundle granularity keeps every bundle bounded no matter how skewed the
tables are:

* patient bundle: one per customer (Patient + optional AllergyIntolerance)
* visit bundle: one per order (Encounter + Condition/Procedure/
  MedicationRequest/Immunization derived from that order)
* observation bundle: per (user, day, block of ``OBS_BLOCK`` event ids),
  so a user holding a third of all events still yields bundles of at most
  ``OBS_BLOCK`` entries.

Two loads: load 1 sends everything; load 2 re-sends the bundles of
patients with ``key % RESEND_MOD = 0`` with changed values (city,
encounter status, observation value) so the dedup winner is visible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the fixture design (the oracle SQL mirrors them).
LOAD1_TS = "2024-02-01 00:00:00"
LOAD2_TS = "2024-03-01 00:00:00"
RESEND_MOD = 5
OBS_BLOCK = 1000
AS_OF_DATE = "2024-12-31"

_EXT_CODING = T.StructType([T.StructField("system", T.StringType()), T.StructField("code", T.StringType()),
                            T.StructField("display", T.StringType())])
_EXT_INNER = T.StructType([T.StructField("url", T.StringType()), T.StructField("valueCoding", _EXT_CODING),
                           T.StructField("valueString", T.StringType())])
_ADDR = T.StructType([T.StructField("city", T.StringType()), T.StructField("state", T.StringType()),
                      T.StructField("country", T.StringType())])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin the rows over the cluster's cores when the scan yields
    fewer partitions than cores (a small single-file table); bundle
    building is CPU-heavy per row.  Large inputs are left as scanned."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def _explode_loads(df: DataFrame, owner: Column, loads: tuple[int, ...]) -> DataFrame:
    """One row per load the source row is sent in: load 1 sends every row,
    load 2 re-sends rows whose owner key is a multiple of RESEND_MOD.  Both
    loads come from one scan of the table."""
    every = [F.lit(x) for x in loads if x == 1]
    resent = [F.lit(x) for x in loads]
    if not every:
        df = df.where(owner % RESEND_MOD == 0)
        return df.withColumn("load", F.explode(F.array(*resent)))
    return df.withColumn("load", F.explode(
        F.when(owner % RESEND_MOD == 0, F.array(*resent)).otherwise(F.array(*every))))


def _by_load(load2: Column, load1: Column) -> Column:
    return F.when(F.col("load") == 2, load2).otherwise(load1)


def _typed_null(t: T.DataType) -> Column:
    return F.lit(None).cast(t)


def _ext(url: str, extension: Column | None = None, valueString: Column | None = None,
         valueCode: Column | None = None, valueAddress: Column | None = None,
         valueDecimal: Column | None = None) -> Column:
    """One patient ``extension`` element; all elements share one struct type
    so they fit in one array (absent fields are dropped by ``to_json``)."""
    return F.struct(
        F.lit(url).alias("url"),
        (extension if extension is not None else _typed_null(T.ArrayType(_EXT_INNER))).alias("extension"),
        (valueString if valueString is not None else _typed_null(T.StringType())).alias("valueString"),
        (valueCode if valueCode is not None else _typed_null(T.StringType())).alias("valueCode"),
        (valueAddress if valueAddress is not None else _typed_null(_ADDR)).alias("valueAddress"),
        (valueDecimal if valueDecimal is not None else _typed_null(T.DoubleType())).alias("valueDecimal"),
    )


def _inner(url: str, coding: Column | None = None, valueString: Column | None = None) -> Column:
    return F.struct(F.lit(url).alias("url"),
                    (coding if coding is not None else _typed_null(_EXT_CODING)).alias("valueCoding"),
                    (valueString if valueString is not None else _typed_null(T.StringType())).alias("valueString"))


def _coding(code: Column, display: Column | None = None) -> Column:
    fields = [code.alias("code")]
    if display is not None:
        fields.append(display.alias("display"))
    return F.struct(F.array(F.struct(*fields)).alias("coding"))


def _ref(prefix: str, key: Column) -> Column:
    return F.struct(F.concat(F.lit("urn:uuid:" + prefix), key.cast("string")).alias("reference"))


def _entry(resource: Column, full_url: Column) -> Column:
    return F.to_json(F.struct(full_url.alias("fullUrl"), resource.alias("resource")))


def _bundle_text(entries_csv: Column) -> Column:
    return F.concat(F.lit('{"resourceType":"Bundle","type":"transaction","entry":['), entries_csv, F.lit("]}"))


def _iso_local(d: Column, clock: str) -> Column:
    return F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(clock))


def patient_bundles(spark: SparkSession, sf_dir: str, loads: tuple[int, ...] = (1, 2)) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    # nation (25 rows) and region (5 rows) have a fixed size at every scale
    src = (spread(cust).join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey, "left")
               .join(F.broadcast(region), F.col("n_regionkey") == region.r_regionkey, "left"))
    src = _explode_loads(src, F.col("c_custkey"), loads)
    k = F.col("c_custkey")
    city = _by_load(F.concat(F.col("n_name"), F.lit("-moved")), F.col("n_name"))
    race = F.element_at(F.array(*[F.lit(x) for x in ["White", "Black", "Asian", "Other"]]), (k % 4 + 1).cast("int"))
    ethnicity = F.when(k % 6 == 0, F.lit("Hispanic or Latino")).otherwise(F.lit("Not Hispanic or Latino"))
    extensions = F.array(
        _ext("us-core-race", extension=F.array(
            _inner("ombCategory", coding=F.struct(F.lit("urn:oid:2.16.840.1.113883.6.238").alias("system"),
                                                  F.concat(F.lit("R"), (k % 4).cast("string")).alias("code"),
                                                  race.alias("display"))),
            _inner("text", valueString=race))),
        _ext("us-core-ethnicity", extension=F.array(
            _inner("ombCategory", coding=F.struct(F.lit("urn:oid:2.16.840.1.113883.6.238").alias("system"),
                                                  F.when(k % 6 == 0, F.lit("E1")).otherwise(F.lit("E2")).alias("code"),
                                                  ethnicity.alias("display"))),
            _inner("text", valueString=ethnicity))),
        _ext("patient-mothersMaidenName", valueString=F.concat(F.lit("Maiden"), (k % 100).cast("string"))),
        _ext("us-core-birthsex", valueCode=F.when(k % 2 == 0, F.lit("M")).otherwise(F.lit("F"))),
        _ext("patient-birthPlace", valueAddress=F.struct(F.col("n_name").alias("city"), F.col("r_name").alias("state"),
                                                         F.lit("US").alias("country"))),
        _ext("disability-adjusted-life-years", valueDecimal=(k % 40).cast("double") / F.lit(8.0)),
        _ext("quality-adjusted-life-years", valueDecimal=(k % 70).cast("double") / F.lit(4.0)),
    )
    given = F.when(k % 3 == 0, F.array(F.col("c_mktsegment"), F.lit("M"))).otherwise(F.array(F.col("c_mktsegment")))
    birth = F.when(k % 50 == 11, F.make_date((F.lit(1932) + k % 18 * 4).cast("int"), F.lit(2), F.lit(29))).otherwise(
        F.make_date((F.lit(1930) + k * 13 % 75).cast("int"), (F.lit(1) + k * 7 % 12).cast("int"),
                    (F.lit(1) + k * 11 % 28).cast("int")))
    patient = F.struct(
        F.lit("Patient").alias("resourceType"),
        F.concat(F.lit("pat-"), k.cast("string")).alias("id"),
        F.element_at(F.array(*[F.lit(x) for x in ["male", "female", "other", "unknown"]]),
                     (k % 4 + 1).cast("int")).alias("gender"),
        F.date_format(birth, "yyyy-MM-dd").alias("birthDate"),
        F.array(F.struct(F.col("c_name").alias("family"), given.alias("given"))).alias("name"),
        F.array(F.struct(
            F.array(F.concat(k.cast("string"), F.lit(" Main St"))).alias("line"),
            city.alias("city"),
            F.col("r_name").alias("state"),
            F.lpad((k % 100000).cast("string"), 5, "0").alias("postalCode"),
            F.lit("US").alias("country"),
            F.array(F.struct(F.array(
                F.struct(F.lit("latitude").alias("url"), ((k % 720).cast("double") / F.lit(8.0) - F.lit(45.0)).alias("valueDecimal")),
                F.struct(F.lit("longitude").alias("url"), ((k % 1440).cast("double") / F.lit(8.0) - F.lit(90.0)).alias("valueDecimal")),
            ).alias("extension"))).alias("extension"),
        )).alias("address"),
        F.array(F.struct(F.lit("phone").alias("system"),
                         F.concat(F.lit("555-"), F.lpad((k % 10000).cast("string"), 4, "0")).alias("value"))).alias("telecom"),
        F.struct(F.element_at(F.array(*[F.lit(x) for x in ["Married", "Never Married", "Divorced"]]),
                              (k % 3 + 1).cast("int")).alias("text")).alias("maritalStatus"),
        F.array(F.struct(F.struct(F.element_at(F.array(*[F.lit(x) for x in ["English", "Spanish", "French", "German", "Chinese"]]),
                                               (k % 5 + 1).cast("int")).alias("text")).alias("language"))).alias("communication"),
        F.when(k % 10 != 9, extensions).alias("extension"),
        F.when(k % 7 == 0, (k % 3 + 1).cast("int")).alias("multipleBirthInteger"),
    )
    allergy = F.struct(
        F.lit("AllergyIntolerance").alias("resourceType"),
        F.concat(F.lit("alg-"), k.cast("string")).alias("id"),
        _coding(F.lit("active")).alias("clinicalStatus"),
        _coding(F.lit("confirmed")).alias("verificationStatus"),
        F.when(k % 4 == 0, F.lit("allergy")).otherwise(F.lit("intolerance")).alias("type"),
        F.array(F.element_at(F.array(*[F.lit(x) for x in ["food", "environment", "medication"]]),
                             ((k % 9) / 3).cast("int") + 1)).alias("category"),
        F.when(k % 12 == 0, F.lit("high")).otherwise(F.lit("low")).alias("criticality"),
        _coding(F.concat(F.lit("A"), (k % 8).cast("string")), F.concat(F.lit("Alg "), (k % 8).cast("string"))).alias("code"),
        _ref("pat-", k).alias("patient"),
        F.lit("2010-01-01T00:00:00Z").alias("recordedDate"),
    )
    entries = F.concat_ws(
        ",",
        _entry(patient, F.concat(F.lit("urn:uuid:pat-"), k.cast("string"))),
        F.when(k % 6 == 0, _entry(allergy, F.concat(F.lit("urn:uuid:alg-"), k.cast("string")))),
    )
    prefix = _by_load(F.lit("raw/fhir/resend/patient/pat-"), F.lit("raw/fhir/patient/pat-"))
    return src.select(F.concat(prefix, k.cast("string"), F.lit(".json")).alias("file_path"),
                      _bundle_text(entries).alias("data"), "load")


def visit_bundles(spark: SparkSession, sf_dir: str, loads: tuple[int, ...] = (1, 2)) -> DataFrame:
    src = spread(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"))
    src = _explode_loads(src, F.col("o_custkey"), loads)
    # one row per order (partial aggregation before the shuffle)
    first_part = (read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
                  .agg(F.min("l_partkey").alias("pk")))
    o = F.col("o_orderkey")
    c = F.col("o_custkey")
    d = F.col("o_orderdate").cast("date")
    os_ = o.cast("string")
    subject = _ref("pat-", c)
    encounter_ref = _ref("enc-", o)
    encounter = F.struct(
        F.lit("Encounter").alias("resourceType"),
        F.concat(F.lit("enc-"), os_).alias("id"),
        _by_load(F.lit("amended"), F.lit("finished")).alias("status"),
        F.struct(F.lit("http://terminology.hl7.org/CodeSystem/v3-ActCode").alias("system"),
                 F.element_at(F.array(F.lit("AMB"), F.lit("EMER"), F.lit("IMP")), (o % 3 + 1).cast("int")).alias("code")).alias("class"),
        F.array(_coding(F.concat(F.lit("ENC"), (o % 5).cast("string")),
                        F.concat(F.lit("Encounter type "), (o % 5).cast("string")))).alias("type"),
        subject.alias("subject"),
        F.struct(F.when(o % 40 != 17, _iso_local(d, "T23:30:00-05:00")).alias("start"),
                 _iso_local(F.date_add(d, (o % 4).cast("int")), "T23:45:00-05:00").alias("end")).alias("period"),
        F.array(F.struct(_ref("prac-", o % 50).alias("individual"))).alias("participant"),
    )
    cond_code = (o * 31 % 23).cast("string")
    condition = F.struct(
        F.lit("Condition").alias("resourceType"),
        F.concat(F.lit("cond-"), os_).alias("id"),
        _coding(F.when(o % 2 == 0, F.lit("resolved")).otherwise(F.lit("active"))).alias("clinicalStatus"),
        _coding(F.lit("confirmed")).alias("verificationStatus"),
        _coding(F.concat(F.lit("C"), cond_code), F.concat(F.lit("Cond "), cond_code)).alias("code"),
        subject.alias("subject"),
        encounter_ref.alias("encounter"),
        _iso_local(d, "T23:30:00-05:00").alias("onsetDateTime"),
        F.when(o % 2 == 0, _iso_local(F.date_add(d, (o % 90).cast("int")), "T23:30:00-05:00")).alias("abatementDateTime"),
    )
    procedure = F.struct(
        F.lit("Procedure").alias("resourceType"),
        F.concat(F.lit("proc-"), os_).alias("id"),
        F.lit("completed").alias("status"),
        _coding(F.concat(F.lit("P"), (o % 12).cast("string")), F.concat(F.lit("Proc "), (o % 12).cast("string"))).alias("code"),
        subject.alias("subject"),
        encounter_ref.alias("encounter"),
        F.struct(_iso_local(d, "T23:30:00-05:00").alias("start"),
                 F.when(o % 8 != 1, _iso_local(F.date_add(d, (o % 3).cast("int")), "T23:45:00-05:00")).alias("end")
                 ).alias("performedPeriod"),
    )
    pk = F.col("pk") % 17
    medication = F.struct(
        F.lit("MedicationRequest").alias("resourceType"),
        F.concat(F.lit("med-"), os_).alias("id"),
        F.when(o % 2 == 0, F.lit("active")).otherwise(F.lit("stopped")).alias("status"),
        F.lit("order").alias("intent"),
        _coding(F.concat(F.lit("M"), pk.cast("string")), F.concat(F.lit("Med "), pk.cast("string"))).alias("medicationCodeableConcept"),
        subject.alias("subject"),
        encounter_ref.alias("encounter"),
        F.struct(F.concat(F.lit("Practitioner?identifier="), (o % 5).cast("string")).alias("reference")).alias("requester"),
        _iso_local(d, "T23:30:00-05:00").alias("authoredOn"),
    )
    immunization = F.struct(
        F.lit("Immunization").alias("resourceType"),
        F.concat(F.lit("imm-"), os_).alias("id"),
        F.lit("completed").alias("status"),
        _coding(F.concat(F.lit("V"), (o % 9).cast("string")), F.concat(F.lit("Vac "), (o % 9).cast("string"))).alias("vaccineCode"),
        _ref("pat-", c).alias("patient"),
        encounter_ref.alias("encounter"),
        _iso_local(d, "T12:00:00Z").alias("occurrenceDateTime"),
    )
    url = lambda p: F.concat(F.lit("urn:uuid:" + p), os_)
    # resources that depend on the order row alone are serialised before
    # the join (in the scan's tasks); the join then moves text, which AQE
    # sizes into enough partitions for the medication part built after it
    pre = src.select(
        "o_orderkey", "o_custkey", "o_orderdate", "load",
        _entry(encounter, url("enc-")).alias("j_enc"),
        F.when(o % 3 == 0, _entry(condition, url("cond-"))).alias("j_cond"),
        F.when(o % 4 == 1, _entry(procedure, url("proc-"))).alias("j_proc"),
        F.when(o % 7 == 0, _entry(immunization, url("imm-"))).alias("j_imm"))
    joined = pre.join(first_part, pre.o_orderkey == first_part.l_orderkey, "left")
    entries = F.concat_ws(
        ",", F.col("j_enc"), F.col("j_cond"), F.col("j_proc"),
        F.when(F.col("pk").isNotNull(), _entry(medication, url("med-"))),
        F.col("j_imm"))
    prefix = _by_load(F.lit("raw/fhir/resend/visit/enc-"), F.lit("raw/fhir/visit/enc-"))
    return joined.select(F.concat(prefix, os_, F.lit(".json")).alias("file_path"),
                         _bundle_text(entries).alias("data"), "load")


def observation_bundles(spark: SparkSession, sf_dir: str, loads: tuple[int, ...] = (1, 2)) -> DataFrame:
    ev = spread(read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value"))
    ev = _explode_loads(ev, F.col("user_id"), loads)
    e = F.col("event_id")
    value = _by_load(F.col("value") + F.lit(1.0), F.col("value"))
    subject = F.when(e % 50 == 7, F.struct(F.concat(F.lit("urn:uuid:ghost-"), e.cast("string")).alias("reference"))) \
               .otherwise(_ref("pat-", F.col("user_id")))
    effective = F.when(
        e % 4 == 0,
        F.concat(F.date_format(F.col("ts") - F.expr("INTERVAL 5 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("-05:00")),
    ).otherwise(F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    obs = F.struct(
        F.lit("Observation").alias("resourceType"),
        F.concat(F.lit("obs-"), e.cast("string")).alias("id"),
        F.lit("final").alias("status"),
        F.array(_coding(F.lit("vital-signs"))).alias("category"),
        _coding(F.col("event_type"), F.concat(F.lit("Obs "), F.col("event_type"))).alias("code"),
        subject.alias("subject"),
        F.when(e % 10 != 3, F.struct(value.alias("value"),
                                     F.when(e % 3 != 0, F.lit("mmHg")).otherwise(F.lit("kg")).alias("unit"))).alias("valueQuantity"),
        effective.alias("effectiveDateTime"),
    )
    day = F.date_format(F.col("ts"), "yyyyMMdd")
    block = (e / OBS_BLOCK).cast("long")
    prefix = _by_load(F.lit("raw/fhir/resend/obs/obs-"), F.lit("raw/fhir/obs/obs-"))
    keyed = ev.select(
        "load",
        F.concat(prefix, F.col("user_id").cast("string"), F.lit("-"), day, F.lit("-"),
                 block.cast("string"), F.lit(".json")).alias("file_path"),
        F.struct(e.alias("id"), _entry(obs, F.concat(F.lit("urn:uuid:obs-"), e.cast("string"))).alias("js")).alias("item"))
    # at most OBS_BLOCK entries per group by construction of the key
    grouped = keyed.groupBy("file_path", "load").agg(F.sort_array(F.collect_list("item")).alias("items"))
    return grouped.select("file_path",
                          _bundle_text(F.array_join(F.transform("items", lambda x: x["js"]), ",")).alias("data"),
                          "load")


def _all_bundles(spark: SparkSession, sf_dir: str, loads: tuple[int, ...]) -> DataFrame:
    return (patient_bundles(spark, sf_dir, loads)
            .unionByName(visit_bundles(spark, sf_dir, loads))
            .unionByName(observation_bundles(spark, sf_dir, loads)))


def bundle_files(spark: SparkSession, sf_dir: str, *loads: int) -> DataFrame:
    """All bundles of one load or several, from one scan of the tables:
    ``(file_path, data)``."""
    return _all_bundles(spark, sf_dir, loads).drop("load")


def fixture_landing(spark: SparkSession, sf_dir: str, loads: tuple[int, ...] = (1, 2)) -> DataFrame:
    """The landing table after the given loads (fixed load timestamps)."""
    b = _all_bundles(spark, sf_dir, tuple(loads))
    ts = F.when(F.col("load") == 2, F.lit(LOAD2_TS)).otherwise(F.lit(LOAD1_TS)).cast("timestamp")
    return b.select("file_path", "data", ts.alias("ingestion_timestamp"))
