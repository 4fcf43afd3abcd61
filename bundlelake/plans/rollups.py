"""Dashboard rollups over the current-state tables.

The panels that count whole facts (conditions, medications, encounters per
month, vitals) are kept as partial states per group, those of the marts that
the current-state tables keep.  ``update`` brings them up to the newest generation in one pass over the facts that changed since
the generation they stand at: as they were with a minus, as they are with a
plus.  Readers add the states up; what they read grows with the number of
groups and updates, not with the facts.

Layout below ``root/state/<era>``: ``rollups/<generation>`` (states added by
one update), ``_rollups`` (the updates that were completed; one that broke
off is not read and is simply repeated).  ``current.compact`` starts a new
era, whose first update counts everything anew.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlelake.operators import partials
from bundlelake.operators.serving import TOP_N
from bundlelake.plans import current
from bundlelake.sources.landing import read_or_empty

LOG_SCHEMA = "gen long"
STATE_SCHEMA = f"panel string, name string, unit string, month date, n long, total {partials.TOTAL}"
GROUPS = ["panel", "name", "unit", "month"]
# mart -> (name, unit, month, measure) of its panel; a panel with a measure leaves out rows without it
PANELS: dict[str, tuple[str | None, str | None, str | None, str | None]] = {
    "fct_conditions": ("condition_description", None, None, None),
    "fct_medications": ("medication_description", "medication_status", None, None),
    "fct_encounters": (None, None, "start_time", None),
    "fct_vitals": ("observation_description", "value_unit", None, "value_quantity"),
}


def _groups(mart: str) -> dict[str, Column]:
    name, unit, day, _ = PANELS[mart]
    text = F.lit(None).cast("string")
    return {"panel": F.lit(mart), "name": F.col(name) if name else text, "unit": F.col(unit) if unit else text,
            "month": F.trunc(day, "month") if day else F.lit(None).cast("date")}


def change(mart: str, was: DataFrame | None, now: DataFrame) -> DataFrame:
    """States that a panel gains when facts are replaced by others."""
    measure = PANELS[mart][3]
    if measure:
        was, now = (None if x is None else x.where(F.col(measure).isNotNull()) for x in (was, now))
    return partials.signed(was, now, _groups(mart), F.col(measure) if measure else None)


def _at(state: current.State, name: str) -> str:
    return f"{state.root}/state/{state.era}/{name}"


def _updates(state: current.State) -> list[int]:
    """Generations that updates have brought the rollups to, up to this one."""
    log = read_or_empty(state.spark, _at(state, "_rollups"), LOG_SCHEMA).where(F.col("gen") <= state.gen)
    return sorted(r["gen"] for r in log.distinct().collect())


def update(spark: SparkSession, root: str, gen: int | None = None) -> int:
    """Bring the rollups up to a generation (default: the newest); returns
    it.  Generations are taken in order: one older than the rollups adds
    nothing, as readers of it have updates of their own."""
    state = current.at_generation(spark, root, gen)
    if state is None:
        raise LookupError(f"no state under {root}")
    done = _updates(state)
    if done and done[-1] >= state.gen:
        return done[-1]
    before = current.at_generation(spark, root, done[-1]) if done else None

    def one(mart: str) -> DataFrame:
        if before is None:
            return change(mart, None, state.mart(mart))
        key, rows = current.KEYS[mart], state.rows(mart)
        ids = rows.where(F.col("_gen") > before.gen).select(F.col(key).alias("_id")).distinct()
        was = before.merged(mart, current.among(before.rows(mart), key, ids))
        return change(mart, was, state.merged(mart, current.among(rows, key, ids)))

    rows = reduce(DataFrame.unionByName, [one(m) for m in PANELS if m in state.marts])
    rows.hint("rebalance").write.mode("overwrite").parquet(_at(state, f"rollups/{state.gen}"))
    spark.range(1).select(F.lit(state.gen).cast("long").alias("gen")).write.mode("append").parquet(_at(state, "_rollups"))
    return state.gen


def panel(spark: SparkSession, root: str, mart: str, gen: int | None = None) -> DataFrame:
    """A panel's groups as of a generation that the rollups were brought to."""
    state = current.at_generation(spark, root, gen)
    done = _updates(state) if state is not None else []
    if not done or done[-1] != state.gen:
        raise LookupError(f"the rollups under {root} do not stand at generation {state.gen if state else gen}")
    if mart not in state.marts:
        raise LookupError(f"the state under {root} does not keep {mart}")
    rows = spark.read.schema(STATE_SCHEMA).parquet(*[_at(state, f"rollups/{g}") for g in done])
    return partials.merged(rows.where(F.col("panel") == mart), GROUPS).where("n > 0")


def top(states: DataFrame, column: str, n: int = TOP_N) -> DataFrame:
    """``serving.top_counts`` from a panel."""
    return (states.groupBy(F.col("name").alias(column)).agg(F.sum("n").alias("count"))
            .orderBy(F.col("count").desc(), F.col(column).asc_nulls_last()).limit(n))


def encounter_trends(states: DataFrame) -> DataFrame:
    """``serving.encounter_trends`` from its panel."""
    return states.groupBy("month").agg(F.sum("n").alias("count")).orderBy(F.col("month").asc_nulls_last())


def vitals_summary(states: DataFrame, min_samples: int = 10) -> DataFrame:
    """``serving.vitals_summary`` from its panel."""
    return (states.where(F.col("n") > min_samples)
            .select(F.col("name").alias("observation_description"), (F.col("total").cast("double") / F.col("n")).alias("avg_value"),
                    F.col("unit").alias("value_unit"), F.col("n").alias("sample_size"))
            .orderBy(F.col("sample_size").desc(), F.col("observation_description").asc_nulls_last(), F.col("value_unit").asc_nulls_last()))
