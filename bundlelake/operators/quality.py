"""Declarative data-quality operators and the audit that gates a publish.

Each check returns the violating rows/values (pass = empty).  ``audit``
runs a whole catalogue and returns one row per test with its violation
count: per table, all ``not_null``/``accepted_values`` checks share one
scan (``count_if`` aggregates); ``unique`` is one partially-aggregated
group-by per column; ``relationships`` is a left-anti join.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundlelake.schemas import ACCEPTED_GENDERS


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values occurring more than once."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Distinct values outside the list (NULL passes)."""
    return (df.where(F.col(column).isNotNull() & ~F.col(column).isin(values))
            .groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")))


def relationships(child: DataFrame, column: str, parent: DataFrame, field_: str) -> DataFrame:
    """Non-NULL child values with no parent row.  All parent keys would be too
    much for a broadcast, however small their compressed column is."""
    keys = parent.select(F.col(field_).alias("_parent_key")).where(F.col("_parent_key").isNotNull())
    c = child.where(F.col(column).isNotNull())
    return c.join(keys.hint("merge"), c[column] == keys["_parent_key"], "left_anti")


def freshness(landing: DataFrame, as_of, warn_after_hours: float = 24.0,
              column: str = "ingestion_timestamp") -> DataFrame:
    """Age of the newest load relative to ``as_of`` (optional check; the
    reference describes but never configures one)."""
    as_of_c = F.lit(str(as_of)).cast("timestamp")
    return (landing.agg(F.max(column).alias("max_loaded_at"))
            .select("max_loaded_at",
                    (F.timestamp_diff("SECOND", F.col("max_loaded_at"), as_of_c) / F.lit(3600.0)).alias("age_hours"))
            .withColumn("is_fresh", F.coalesce(F.col("age_hours") <= F.lit(warn_after_hours), F.lit(False))))


@dataclass(frozen=True)
class Check:
    model: str
    test: str              # unique | not_null | accepted_values | relationships
    column: str
    values: tuple = field(default=())
    to: str | None = None  # relationships: parent model
    to_field: str | None = None


def _stg(model: str, key: str) -> list[Check]:
    return [Check(model, "unique", key), Check(model, "not_null", key),
            Check(model, "not_null", "patient_id"), Check(model, "not_null", "dbt_processed_at")]


def _fct(model: str, key: str) -> list[Check]:
    return [Check(model, "unique", key), Check(model, "not_null", key),
            Check(model, "not_null", "patient_id"),
            Check(model, "relationships", "patient_id", to="dim_patients", to_field="patient_id")]


# The reference's 61 declared tests (34 staging + 27 marts).
STAGING_CHECKS = [
    Check("stg_patients", "unique", "patient_id"),
    Check("stg_patients", "not_null", "patient_id"),
    Check("stg_patients", "accepted_values", "gender", tuple(ACCEPTED_GENDERS)),
    Check("stg_patients", "not_null", "birth_date"),
    Check("stg_patients", "not_null", "file_path"),
    Check("stg_patients", "not_null", "dbt_processed_at"),
    *_stg("stg_encounters", "encounter_id"),
    *_stg("stg_conditions", "condition_id"),
    *_stg("stg_observations", "observation_id"),
    *_stg("stg_medication_requests", "medication_request_id"),
    *_stg("stg_procedures", "procedure_id"),
    *_stg("stg_immunizations", "immunization_id"),
    *_stg("stg_allergy_intolerances", "allergy_id"),
]
MART_CHECKS = [
    Check("dim_patients", "unique", "patient_id"),
    Check("dim_patients", "not_null", "patient_id"),
    Check("dim_patients", "not_null", "dbt_updated_at"),
    *_fct("fct_encounters", "encounter_id"),
    *_fct("fct_conditions", "condition_id"),
    *_fct("fct_medications", "medication_request_id"),
    *_fct("fct_procedures", "procedure_id"),
    *_fct("fct_immunizations", "immunization_id"),
    *_fct("fct_vitals", "observation_id"),
]
ALL_CHECKS = STAGING_CHECKS + MART_CHECKS


def row_condition(c: Check):
    col = F.col(c.column)
    return col.isNull() if c.test == "not_null" else (col.isNotNull() & ~col.isin(list(c.values)))


def stacked(model: str, wide: DataFrame, labels: list[tuple[str, str, str]]) -> DataFrame:
    """One-row ``wide`` (columns named in ``labels``) -> one row per check."""
    stack = ", ".join(f"'{test}', '{column}', coalesce({name}, 0L)" for test, column, name in labels)
    return (wide.selectExpr(f"stack({len(labels)}, {stack}) as (test, column, violations)")
            .select(F.lit(model).alias("model"), "test", "column", F.col("violations").cast("long")))


class MissingTable(ValueError):
    """A declared test names a table that the build does not have."""


def _dangling(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """All ``relationships`` tests of one parent: the children's values are
    counted per table, put together and anti-joined with the parent once."""
    keys = tables[checks[0].to].select(F.col(checks[0].to_field).alias("_parent")).where("_parent is not null")
    values = reduce(DataFrame.unionByName, [
        tables[c.model].where(F.col(c.column).isNotNull()).groupBy(F.col(c.column).alias("_value")).agg(F.count("*").alias("_n"))
        .withColumn("_check", F.lit(i)) for i, c in enumerate(checks)])
    lost = values.join(keys.hint("merge"), F.col("_value") == F.col("_parent"), "left_anti")
    sums = [F.coalesce(F.sum(F.when(F.col("_check") == i, F.col("_n"))), F.lit(0)).alias(f"r{i}") for i in range(len(checks))]
    rows = F.array(*[F.struct(F.lit(c.model).alias("model"), F.lit(c.test).alias("test"), F.lit(c.column).alias("column"),
                              F.col(f"r{i}").cast("long").alias("violations")) for i, c in enumerate(checks)])
    return lost.agg(*sums).select(F.explode(rows).alias("r")).select("r.*")


def audit(tables: dict[str, DataFrame], checks: list[Check] | None = None) -> DataFrame:
    """Run checks over the given tables -> ``(model, test, column, violations)``.

    Per table, the first ``unique`` check and every ``not_null`` /
    ``accepted_values`` check share one scan and one shuffle: rows are
    grouped by the unique key (partial aggregation first) carrying
    per-key counts of the row conditions, which are then summed.  Other
    ``unique`` checks group by their own column; ``relationships`` share one
    anti-join per parent.  A check whose table or parent is absent, or an
    empty catalogue, is an error: nothing passes by not being tested.
    """
    checks = list(ALL_CHECKS if checks is None else checks)
    absent = sorted({m for c in checks for m in (c.model, c.to) if m and m not in tables})
    if absent or not checks:
        raise MissingTable(f"no table for the tests of {', '.join(absent)}" if absent else "no tests given")
    parts = []
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        by_model.setdefault(c.model, []).append(c)
    for model, cs in by_model.items():
        df = tables[model]
        row_checks = [c for c in cs if c.test in ("not_null", "accepted_values")]
        uniques = [c for c in cs if c.test == "unique"]
        labels = [(c.test, c.column, f"c{i}") for i, c in enumerate(row_checks)]
        if uniques:
            key = uniques[0].column
            per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"),
                                          *[F.count_if(row_condition(c)).alias(f"c{i}")
                                            for i, c in enumerate(row_checks)])
            wide = per_key.agg(F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).alias("u0"),
                               *[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(row_checks))])
            parts.append(stacked(model, wide, [("unique", key, "u0")] + labels))
            uniques = uniques[1:]
        elif row_checks:
            wide = df.agg(*[F.count_if(row_condition(c)).alias(f"c{i}") for i, c in enumerate(row_checks)])
            parts.append(stacked(model, wide, labels))
        for c in uniques:
            v = unique(df, c.column).agg(F.count(F.lit(1)).alias("violations"))
            parts.append(v.select(F.lit(model).alias("model"), F.lit("unique").alias("test"),
                                  F.lit(c.column).alias("column"), "violations"))
    by_parent: dict[tuple, list[Check]] = {}
    for c in checks:
        if c.test == "relationships":
            by_parent.setdefault((c.to, c.to_field), []).append(c)
    parts += [_dangling(tables, cs) for cs in by_parent.values()]
    return reduce(DataFrame.unionByName, parts)
