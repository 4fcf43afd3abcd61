"""Watermark filter and keyed upsert (whole incremental builds:
``plans.current``).

Parquet has no ``MERGE INTO``; an upsert is ``target UNION new`` reduced
to the newest row per key and written as a new table version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundlelake.operators.staging import dedup_latest


def watermark(target: DataFrame, column: str = "ingested_at"):
    """``(SELECT MAX(column) FROM target)`` as a scalar-subquery column."""
    return target.select(F.max(column)).scalar()


def watermark_value(target: DataFrame, column: str = "ingested_at") -> str | None:
    """The target's watermark as text (session time zone, microseconds);
    one global aggregate, one value to the driver."""
    row = target.agg(F.date_format(F.max(column), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("w")).first()
    return row["w"] if row is not None else None


def incremental_filter(source: DataFrame, target: DataFrame, column: str = "ingested_at",
                       empty_target_loads_all: bool = True, eager: bool = True) -> DataFrame:
    """Rows strictly newer than the target's watermark.

    By default the watermark is computed first and applied as a literal,
    so the comparison is pushed into the Parquet scan and row groups (in
    practice, whole earlier runs) are skipped by their min/max statistics;
    ``eager=False`` keeps it as a scalar subquery inside one plan, which
    cannot be pushed down.  With an empty target the reference's
    comparison is NULL and loads nothing; by default an empty target is
    treated as a first load.
    """
    if eager:
        wm = watermark_value(target, column)
        if wm is None:
            return source if empty_target_loads_all else source.limit(0)
        return source.where(F.col(column) > F.lit(wm).cast(dict(source.dtypes)[column]))
    cond = F.col(column) > watermark(target, column)
    if empty_target_loads_all:
        cond = F.coalesce(cond, F.lit(True))
    return source.where(cond)


def upsert(target: DataFrame, new: DataFrame, key: str, order_column: str = "ingested_at") -> DataFrame:
    """Newest row per ``key`` over target and new rows (new rows win ties).
    Only the target rows whose key comes again are compared; the rest of the
    target passes an anti-join with the new keys (no window over it, and no
    shuffle where the keys are few enough to be broadcast)."""
    keys = new.select(F.col(key).alias("_key")).distinct()
    again = target.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_semi").withColumn("_src", F.lit(0))
    both = again.unionByName(new.select(*target.columns).withColumn("_src", F.lit(1)))
    newest = dedup_latest(both, key, [F.col(order_column).desc_nulls_last(), F.col("_src").desc()]).drop("_src")
    return target.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_anti").unionByName(newest)
