"""Skew: one patient holding a third of all facts, one resource id re-sent
a third of the time.  Results must stay whole and exact; the join must be
split by AQE instead of landing in one task."""

import datetime as dt

from pyspark.sql import functions as F

from bundlelake.operators import marts as M
from bundlelake.operators import quality as Q
from bundlelake.operators.staging import dedup_latest


def _conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _observations(spark, n=30000, hot_share=3):
    # every third observation belongs to patient pat-0
    return spark.range(n).select(
        F.concat(F.lit("obs-"), F.col("id").cast("string")).alias("observation_id"),
        F.when(F.col("id") % hot_share == 0, F.lit("pat-0"))
         .otherwise(F.concat(F.lit("pat-"), (F.col("id") % 997 + 1).cast("string"))).alias("patient_id"),
        F.lit(None).cast("string").alias("encounter_id"),
        F.lit("vital-signs").alias("category"),
        F.lit("c").alias("observation_code"),
        F.lit("Obs c").alias("observation_description"),
        (F.col("id") % 100).cast("double").alias("value_quantity"),
        F.lit("kg").alias("value_unit"),
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp").alias("effective_date"),
        F.current_timestamp().alias("ingested_at"))


def _patients(spark):
    return spark.range(0, 998).select(
        F.concat(F.lit("pat-"), F.col("id").cast("string")).alias("patient_id"),
        F.lit("female").alias("gender"), F.lit("Asian").alias("race"), F.lit("E").alias("ethnicity"),
        F.lit(dt.date(1990, 1, 1)).alias("birth_date"))


def test_hot_patient_join_is_split_and_whole(spark):
    old = _conf(spark, **{
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    })
    try:
        obs = _observations(spark)
        out = M.fct_vitals(obs, _patients(spark))
        rows = out.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n"), F.count("patient_gender").alias("g"))
        got = {r.patient_id: (r.n, r.g) for r in rows.collect()}
        assert sum(n for n, _ in got.values()) == 30000
        assert got["pat-0"] == (10000, 10000)
        assert len(out.collect()) == 30000
        plan = out._jdf.queryExecution().executedPlan().toString()  # final adaptive plan of that run
        assert "SortMergeJoin" in plan
        assert "isSkewJoin=true" in plan or "skew=true" in plan.lower()
    finally:
        _restore(spark, old)


def test_hot_resource_id_dedup(spark):
    n = 9000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("observation_id"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp") + F.make_interval(secs=F.col("id").cast("int")))
         .alias("ingestion_timestamp"),
        F.lit("f.json").alias("file_path"), F.lit(0).alias("_pos"), F.col("id").alias("v"))
    out = dedup_latest(df, "observation_id")
    assert out.count() == n - n // 3 + 1
    assert out.where("observation_id = 'hot'").first().v == 8997
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_hot_key_unique_and_relationships(spark):
    obs = _observations(spark)
    assert Q.unique(obs, "patient_id").where("patient_id = 'pat-0'").first().n_rows == 10000
    pats = _patients(spark).where("patient_id <> 'pat-0'")
    assert Q.relationships(obs, "patient_id", pats, "patient_id").count() == 10000
