"""Aggregates that can be taken back.

A group's state is the number of its rows and the sum of a measure.  When
rows are replaced, moved or withdrawn, the rows as they were count with a
minus and the rows as they are with a plus; states of any number of loads
add up.  So an aggregate is brought up to date from the changed rows alone,
and MIN and MAX, which cannot be subtracted, come from counted values: the
least and the greatest value that still has a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# sums are kept as decimals: unlike doubles they are the same in any order, and what is taken back leaves nothing
TOTAL = "decimal(38,9)"


def signed(was: DataFrame | None, now: DataFrame, groups: dict[str, Column], measure: Column | None = None) -> DataFrame:
    """Groups that change, with the change of their row count ``n`` and of
    ``total``, the measure's sum (to nine places; a null measure adds
    nothing).  Rows that stay as they are cancel out before the write."""
    value = F.lit(None).cast(TOTAL) if measure is None else measure.cast(TOTAL)

    def side(rows: DataFrame, sign: int) -> DataFrame:
        return rows.select(*[c.alias(g) for g, c in groups.items()], F.lit(sign).cast("long").alias("n"), (value * sign).cast(TOTAL).alias("total"))

    rows = side(now, 1) if was is None else side(now, 1).unionByName(side(was, -1))
    return merged(rows, list(groups)).where("n <> 0 or total <> 0")


def merged(states: DataFrame, groups: list[str]) -> DataFrame:
    """The states of several loads as one."""
    return states.groupBy(*groups).agg(F.sum("n").alias("n"), F.coalesce(F.sum("total"), F.lit(0)).cast(TOTAL).alias("total"))


def visit_days(was: DataFrame | None, now: DataFrame) -> DataFrame:
    """Counted days of encounters per patient; a null day counts as one."""
    return signed(was, now, {"patient_id": F.col("patient_id"), "start_time": F.col("start_time")}).drop("total")


def patient_stats(days: DataFrame) -> DataFrame:
    """``marts.patient_encounter_stats`` from counted days.  A patient
    without an encounter left has no row."""
    left = days.groupBy("patient_id", "start_time").agg(F.sum("n").alias("n")).where("n > 0")
    return left.groupBy("patient_id").agg(F.min("start_time").alias("first_encounter_date"), F.max("start_time").alias("last_encounter_date"),
                                          F.sum("n").alias("total_encounters"))
