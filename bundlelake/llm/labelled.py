"""Labelled rows for the trained operators: the hold-out rule and a bounded
training sample.  Labels are looked up by document, never used as inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOLD_OUT = 5
MAX_LABELLED = 20_000  # labels in a training sample: the first by a hash of the id


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5, is 0 (a null id is not held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % HOLD_OUT == 0, F.lit(False))


def first_by_hash(rows: DataFrame, hashed: Column, n: int) -> DataFrame:
    """The ``n`` rows of the smallest hashes.  A share of the hash range that
    holds half as many again (and 1000) is taken first, so the final ordering
    sees a bounded number of rows from any number of partitions."""
    share = min(1.0, (1.5 * n + 1000) / max(1, rows.count()))
    within = F.lit(True) if share >= 1 else hashed < F.lit(int(-(1 << 63) + share * (1 << 64)))
    return rows.where(within).orderBy(hashed, *rows.columns).limit(n)


def labels_known(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) outside the held-out fold.  A document with several
    label rows has their maximum."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
            .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")))


def known_labels(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``labels_known`` of the documents that are there."""
    return labels_known(labels, label).join(docs.select("doc_id"), "doc_id", "left_semi")


def _texts(docs: DataFrame, known: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(known, "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")


def training_rows(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, text, label) of every labelled document outside the held-out
    fold; a repeated document counts once."""
    return _texts(docs, known_labels(docs, labels, label))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, text, label) of at most ``max_labelled`` documents outside
    the held-out fold.  Labels of documents that are not there (any more) do
    not use up the sample.  A document with several label rows has their maximum;
    a repeated document counts once.  The label side of the join is bounded
    by ``max_labelled`` rows of two numbers, so it is broadcast."""
    few = first_by_hash(known_labels(docs, labels, label), F.xxhash64("doc_id"), max_labelled)
    return _texts(docs, F.broadcast(few))
