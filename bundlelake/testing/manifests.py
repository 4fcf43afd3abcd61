"""Raw-file manifests derived from the driver's ``documents`` table.

Each document stands for one raw object: key
``raw/<source>/<doc_id>.json`` (``.txt`` for every tenth id, which the
ingestion must skip), size = UTF-8 byte length, body = the text.  Docs
listed in ``labels`` count as already ingested.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlelake.schemas import LANDING_SCHEMA
from bundlelake.testing.fixtures import read_table

# Fixed values of the fixture design (mirrored by the oracle SQL).
DOC_SIZE_LIMIT = 3000
DOC_CAP = 100
DOC_LOAD_TS = "2024-01-15 00:00:00"


def doc_key(doc_id, source):
    return F.concat(F.lit("raw/"), source, F.lit("/"), doc_id.cast("string"),
                    F.when(doc_id % 10 == 0, F.lit(".txt")).otherwise(F.lit(".json")))


def document_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, body)`` for every document; the bytes of every seventeenth
    are not UTF-8."""
    d = read_table(spark, sf_dir, "documents")
    body = F.encode(F.col("text"), "UTF-8")
    return d.select(doc_key(F.col("doc_id"), F.col("source")).alias("path"),
                    F.when(F.col("doc_id") % 17 == 5, F.concat(F.lit(bytearray(b"\xff")), body)).otherwise(body).alias("body"))


def repaired_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The undecodable documents, decodable."""
    d = read_table(spark, sf_dir, "documents").where("doc_id % 17 = 5")
    return d.select(doc_key(F.col("doc_id"), F.col("source")).alias("path"), F.encode("text", "UTF-8").alias("body"))


def document_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, length, content)`` as a listing would return it."""
    return document_objects(spark, sf_dir).select(
        "path", F.octet_length("body").cast("long").alias("length"), F.col("body").alias("content"))


def labelled_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing table holding the labelled documents (the ledger)."""
    d = read_table(spark, sf_dir, "documents")
    lab = read_table(spark, sf_dir, "labels").select("doc_id").distinct()
    seen = d.join(lab, "doc_id", "left_semi")
    return seen.select(doc_key(F.col("doc_id"), F.col("source")).alias("file_path"), F.col("text").alias("data"),
                       F.lit(DOC_LOAD_TS).cast("timestamp").alias("ingestion_timestamp")).select(
        *LANDING_SCHEMA.fieldNames())
