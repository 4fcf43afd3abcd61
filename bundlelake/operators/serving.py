"""Dashboard aggregates over the marts.

Global totals (histogram bounds, KPIs) are scalar subqueries: each is a
global aggregate with partial aggregation, evaluated once, so no query
funnels rows through a single task or the driver.  Shares are taken of the
sum of the groups' counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOP_N = 10  # fixed value: the dashboard's top-k size


def demographics(dim: DataFrame) -> DataFrame:
    return dim.select("gender", "race", "ethnicity", "age_years")


def top_counts(df: DataFrame, column: str, n: int = TOP_N) -> DataFrame:
    """``GROUP BY c ORDER BY count DESC LIMIT n`` with a name tie-break so
    the result is deterministic (planned as TakeOrderedAndProject)."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.col("count").desc(), F.col(column).asc_nulls_last())
              .limit(n))


def top_conditions(fct_conditions: DataFrame, n: int = TOP_N) -> DataFrame:
    return top_counts(fct_conditions, "condition_description", n)


def top_medications(fct_medications: DataFrame, n: int = TOP_N) -> DataFrame:
    return top_counts(fct_medications, "medication_description", n)


def encounter_trends(fct_encounters: DataFrame) -> DataFrame:
    """Encounters per calendar month of ``start_time`` (a DATE)."""
    return (fct_encounters.groupBy(F.trunc("start_time", "month").alias("month"))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("month").asc_nulls_last()))


def vitals_summary(fct_vitals: DataFrame, min_samples: int = 10) -> DataFrame:
    return (fct_vitals.where(F.col("value_quantity").isNotNull())
            .groupBy("observation_description", "value_unit")
            .agg(F.avg("value_quantity").alias("avg_value"), F.count(F.lit(1)).alias("sample_size"))
            .where(F.col("sample_size") > min_samples)
            .select("observation_description", "avg_value", "value_unit", "sample_size")
            .orderBy(F.col("sample_size").desc(), F.col("observation_description").asc_nulls_last(),
                     F.col("value_unit").asc_nulls_last()))


def vital_lookup(summary: DataFrame, description: str) -> DataFrame:
    """Average and unit of one vital: the summary's first row for it, that
    is the unit with the most samples (ties: by unit)."""
    return (summary.where(F.col("observation_description") == F.lit(description))
            .orderBy(F.col("sample_size").desc(), F.col("value_unit").asc_nulls_last())
            .limit(1)
            .select("observation_description", "avg_value", "value_unit"))


def age_histogram(dim: DataFrame, bins: int = 20) -> DataFrame:
    """Counts per (age bin, gender); at most ``bins`` equal-width bins over
    the observed age range."""
    bounds = dim.agg(F.min("age_years").alias("lo"), F.max("age_years").alias("hi"))
    lo = bounds.select("lo").scalar()
    width = bounds.select(F.greatest(F.lit(1), F.ceil((F.col("hi") - F.col("lo") + 1) / F.lit(bins)))).scalar()
    binned = dim.where(F.col("age_years").isNotNull()).select(
        (lo + F.floor((F.col("age_years") - lo) / width) * width).cast("long").alias("age_bin_start"),
        width.cast("long").alias("bin_width"),
        "gender")
    return (binned.groupBy("age_bin_start", "bin_width", "gender").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("age_bin_start", F.col("gender").asc_nulls_last()))


def race_distribution(dim: DataFrame) -> DataFrame:
    """The total is the sum of the races' counts: the dimension is read once,
    and what the window gathers is one row per race."""
    counts = dim.groupBy("race").agg(F.count(F.lit(1)).alias("count"))
    return (counts.select("race", "count", (F.col("count") / F.sum("count").over(Window.partitionBy())).alias("share"))
            .orderBy(F.col("count").desc(), F.col("race").asc_nulls_last()))


def kpis(dim: DataFrame, fct_conditions: DataFrame, fct_medications: DataFrame,
         fct_encounters: DataFrame, n: int = TOP_N) -> DataFrame:
    """The four dashboard tiles, each as shown (bounded by the top-n
    lists, as the dashboard computes them) and as the true figure."""
    top_c = top_conditions(fct_conditions, n)
    top_m = top_medications(fct_medications, n)
    trends = encounter_trends(fct_encounters)
    one = lambda agg: trends.agg(agg.alias("v")).select(F.coalesce("v", F.lit(0).cast("long"))).scalar()
    # as shown: the trend's last row, which is the one without a month if there is one
    last_row = F.max_by("count", F.struct(F.col("month").isNull(), F.col("month")))
    return dim.agg(F.count(F.lit(1)).alias("total_patients")).select(
        "total_patients",
        top_c.select(F.count(F.lit(1))).scalar().alias("unique_conditions_shown"),
        fct_conditions.select(F.countDistinct("condition_description")).scalar().alias("unique_conditions"),
        top_m.select(F.coalesce(F.sum("count"), F.lit(0).cast("long"))).scalar().alias("active_medications_shown"),
        fct_medications.select(F.count_if(F.col("medication_status") == "active")).scalar().alias("active_medications"),
        one(last_row).alias("latest_month_volume_shown"),
        one(F.max_by("count", "month")).alias("latest_month_volume"),
    )
