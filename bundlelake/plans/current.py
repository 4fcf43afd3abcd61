"""Current-state tables: an hourly build that costs what the hour brought.

Staging models and marts are kept as Parquet tables bucketed by their key.
A build appends the rows that a new load changes, as one generation; it
rewrites nothing.  A reader takes the newest row of each key up to its
version's generation.  Since the scan is partitioned by the key's hash, that
merge, the joins on the key and the grouping by it need no exchange of what
is already there: only the new rows move.

Besides the models there is one table of links (patient, model, id),
bucketed by patient, which finds the facts of a patient sent again without
a scan of all facts.  A link is never withdrawn; the row it leads to tells
whom it belongs to now.  And there is one table of counted encounter days per
patient: moved and withdrawn encounters are taken off it again, so a
patient's first, last and number of encounters need no look at the history.

Layout below ``root/state``: ``_log`` (generations begun and completed, with
the loads they hold), ``<era>/<table>``.  ``compact`` folds the generations
into a new era.  A generation that was begun but not completed is never
read, so a run that broke off is simply repeated.  One writer at a time.

A state keeps all models, or some marts with the staging models they read
(``apply(marts=...)``); the log says which.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache, reduce
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from bundlelake.operators import marts as M
from bundlelake.operators import partials, quality
from bundlelake.operators.quality import Check
from bundlelake.operators.staging import stage_typed
from bundlelake.schemas import STAGING_SPECS, typed_schema
from bundlelake.sources.landing import read_or_empty

LOG_SCHEMA = "era string, gen long, buckets int, load string, n long, completed boolean, at timestamp, marts string"
LINKS = "links"
DAYS = "visit_days"
AT_ONCE = 8  # appends running side by side: most are small
FACT_OF = {model: (mart, fn) for mart, (fn, model) in M.FACTS.items()}
KEYS = {m: s["key"] for m, s in STAGING_SPECS.items()} | M.MART_KEYS | {LINKS: "patient_id", DAYS: "patient_id"}


class State:
    """The tables as of one generation."""

    def __init__(self, spark: SparkSession, root: str, era: str, gen: int, buckets: int, void: tuple[int, ...] = (), marts: str | None = None):
        """``marts``: names of the marts that are kept, by comma (none: all models)."""
        self.spark, self.root, self.era, self.gen, self.buckets, self.void = spark, root.rstrip("/"), era, gen, buckets, void
        self.only = marts
        self.marts = [m for m in M.MART_KEYS if marts is None or m in marts.split(",")]
        self.models = [m for m in STAGING_SPECS if marts is None or any(m in M.sources(x) for x in self.marts)]
        self.facts = [m for m in self.models if m in FACT_OF and FACT_OF[m][0] in self.marts]

    def _name(self, table: str) -> str:
        """The bucketed table in this session's catalog, over its folder."""
        at = f"{self.root}/state/{self.era}/{table}"
        name = f"state_{md5(at.encode()).hexdigest()[:16]}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*_schema(table), StructField("_gen", LongType())])
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{KEYS[table]}`) SORTED BY (`{KEYS[table]}`) "
                           f"INTO {self.buckets} BUCKETS LOCATION '{at}'")
        return name

    def append(self, table: str, rows: DataFrame) -> None:
        """One file per bucket that has rows."""
        name = self._name(table)
        rows = rows.select(*_schema(table).fieldNames(), F.lit(self.gen).cast("long").alias("_gen"))
        rows.repartition(self.buckets, KEYS[table]).write.insertInto(name)
        self.spark.catalog.refreshTable(name)

    def rows(self, table: str) -> DataFrame:
        """All rows up to this generation."""
        rows = self.spark.table(self._name(table)).where(F.col("_gen") <= self.gen)
        return rows.where(~F.col("_gen").isin(*self.void)) if self.void else rows

    def merged(self, table: str, rows: DataFrame, dedup_allergies: bool = False) -> DataFrame:
        """The newest of the given rows of each key, without helper columns.
        Allergies keep every copy unless asked otherwise."""
        if table in STAGING_SPECS and not (STAGING_SPECS[table]["dedup"] or dedup_allergies):
            return rows.drop("_gen", "_pos")
        order = ["ingestion_timestamp", "file_path", "_pos", "_gen"] if table in STAGING_SPECS else ["_gen"]
        newest = F.row_number().over(Window.partitionBy(KEYS[table]).orderBy(*[F.col(c).desc() for c in order]))
        return rows.withColumn("_rn", newest).where("_rn = 1").drop("_rn", "_gen", "_pos")

    def staging(self, model: str, dedup_allergies: bool = False) -> DataFrame:
        return self.merged(model, self.rows(model), dedup_allergies)

    def mart(self, name: str, as_of_date=None) -> DataFrame:
        """``age_years`` is as of the day of the run, so it is computed here."""
        rows = self.merged(name, self.rows(name))
        return rows.withColumn("age_years", M.age_at(F.col("birth_date"), as_of_date)) if name == "dim_patients" else rows

    def tables(self, as_of_date=None, dedup_allergies: bool = False) -> dict[str, DataFrame]:
        return {m: self.staging(m, dedup_allergies) for m in self.models} | {m: self.mart(m, as_of_date) for m in self.marts}


@lru_cache(maxsize=None)
def _schema(table: str) -> StructType:
    """Columns of a table, without its generation."""
    spark = SparkSession.active()
    if table == LINKS:
        return StructType().add("patient_id", "string").add("model", "string").add("id", "string")
    if table == DAYS:
        return StructType().add("patient_id", "string").add("start_time", "date").add("n", "long")
    nothing = spark.createDataFrame([], typed_schema())
    if table in STAGING_SPECS:
        return stage_typed(nothing, table, dedup=False, keep_pos=True).schema
    return M.build_marts({m: stage_typed(nothing, m, dedup=False) for m in STAGING_SPECS})[table].schema


def _log(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, f"{root.rstrip('/')}/state/_log", LOG_SCHEMA)


def _note(state: State, loads: list[tuple[str, int]], completed: bool) -> None:
    rows = [(state.era, state.gen, state.buckets, load, n, completed, state.only) for load, n in (loads or [(None, 0)])]
    (state.spark.createDataFrame(rows, "era string, gen long, buckets int, load string, n long, completed boolean, marts string")
     .withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{state.root}/state/_log"))


def _history(spark: SparkSession, root: str) -> list:
    """One row per generation, oldest first."""
    return (_log(spark, root).groupBy("gen", "era", "buckets").agg(F.bool_or("completed").alias("done"), F.max("marts").alias("marts"))
            .orderBy("gen").collect())


def _as_of(spark: SparkSession, root: str, history: list, row) -> State:
    void = tuple(r["gen"] for r in history if not r["done"] and r["era"] == row["era"] and r["gen"] < row["gen"])
    return State(spark, root, row["era"], row["gen"], row["buckets"], void, row["marts"])


def at_generation(spark: SparkSession, root: str, gen: int | None = None) -> State | None:
    """The state as of a generation (default: the newest completed one)."""
    history = _history(spark, root)
    done = [r for r in history if r["done"] and gen in (None, r["gen"])]
    return _as_of(spark, root, history, done[-1]) if done else None


def _begin(spark: SparkSession, root: str, buckets: int | None, new_era: bool = False, marts: Iterable[str] | None = None) -> tuple[State | None, State]:
    """(the state before, an empty generation after it)."""
    only = None if marts is None else ",".join(m for m in M.MART_KEYS if m in set(marts))
    history = _history(spark, root)
    done = [r for r in history if r["done"]]
    before = _as_of(spark, root, history, done[-1]) if done else None
    if before is not None:
        if marts is not None and only != before.only:
            raise ValueError(f"the state under {root} keeps {before.only or 'all models'}")
        only = before.only
    gen = history[-1]["gen"] + 1 if history else 1
    if before is None or new_era:
        size = buckets or (before.buckets if before else int(spark.conf.get("spark.sql.shuffle.partitions")))
        after = State(spark, root, f"era-{gen}", gen, size, marts=only)
    else:
        after = _as_of(spark, root, history, {"era": before.era, "gen": gen, "buckets": before.buckets, "marts": only})
    _note(after, [], False)
    return before, after


def _side_by_side(jobs: list[Callable[[], None]]) -> None:
    """Independent appends; the first error is raised when all have ended."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


def pending_loads(spark: SparkSession, root: str, loads: DataFrame) -> list[tuple[str, int]]:
    """Of the typed-entries log ``(load, n)``: what the state does not hold
    as it is now."""
    held = _log(spark, root).where("completed and load is not null").select("load", F.col("n").alias("held"))
    now = loads.groupBy("load").agg(F.max("n").alias("n"))
    new = now.join(held, (now["load"] == held["load"]) & (now["n"] == held["held"]), "left_anti")
    return [(r["load"], r["n"]) for r in new.collect()]  # one row per load not yet built


def among(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows whose key is one of ``_id``, and those without a key.  A plain
    equality keeps the table's partitioning by key, and the merge hint moves
    the ids there: file sizes say too little of what a broadcast would hold."""
    return rows.join(ids.hint("merge"), F.col(key) == F.col("_id"), "left_semi").unionByName(rows.where(F.col(key).isNull()))


def apply(spark: SparkSession, root: str, typed: DataFrame, loads: list[tuple[str, int]] = (), as_of_date=None,
          buckets: int | None = None, marts: Iterable[str] | None = None) -> State:
    """Bring the state up to date with the typed rows of new loads.
    ``marts``: those that a new state is to keep, with the staging models
    they read (default: all models); later generations keep the same.

    What changes is found from the new rows alone: the facts among them, the
    facts linked to patients sent again, and the dimension rows of patients
    sent again or with an encounter that came, went or moved.  Equal to a
    build from everything as long as no source row disappears."""
    before, now = _begin(spark, root, buckets, marts=marts)
    new = {m: stage_typed(typed, m, False, keep_pos=True) for m in now.models}  # copies are merged by readers
    links = None
    for m in now.facts:
        pairs = new[m].where("patient_id is not null").select("patient_id", F.lit(m).alias("model"), F.col(KEYS[m]).alias("id"))
        links = pairs if links is None else links.unionByName(pairs)
    _side_by_side([lambda m=m: now.append(m, new[m]) for m in now.models] + [lambda: now.append(LINKS, links.distinct())] * bool(now.facts))

    # from here on the new rows are read back from their generation
    fresh = {m: now.rows(m).where(F.col("_gen") == now.gen) for m in now.models}
    patients = now.staging("stg_patients").hint("merge")  # joined by its bucket key, never sent through the driver
    resent = fresh["stg_patients"].select("patient_id").where("patient_id is not null").distinct()

    def changed(model: str, of: DataFrame) -> DataFrame:
        """Current rows among the new ones, or linked to the given patients."""
        key = KEYS[model]
        if before is None:  # all rows are new
            return now.staging(model)
        linked = now.rows(LINKS).drop("_gen").where(F.col("model") == model).join(of.hint("merge"), "patient_id", "left_semi").select(F.col("id").alias("_id"))
        ids = fresh[model].select(F.col(key).alias("_id")).unionByName(linked).distinct()
        return now.merged(model, among(now.rows(model), key, ids))

    def days() -> DataFrame:
        """What encounters that came, went or moved change in counted days."""
        if before is None or now.rows(DAYS).isEmpty():  # nothing was counted yet
            return partials.visit_days(None, now.staging("stg_encounters"))
        ids = fresh["stg_encounters"].select(F.col("encounter_id").alias("_id")).distinct()
        was, new_rows = (x.merged("stg_encounters", among(x.rows("stg_encounters"), "encounter_id", ids)) for x in (before, now))
        return partials.visit_days(was, new_rows)

    def dimension() -> DataFrame:
        counted = now.rows(DAYS)
        if before is None:
            return M.dim_patients(now.staging("stg_patients"), None, as_of_date, stats=partials.patient_stats(counted.drop("_gen")).hint("merge"))
        touched = resent.unionByName(counted.where((F.col("_gen") == now.gen) & F.col("patient_id").isNotNull()).select("patient_id")).distinct()
        ids = touched.select(F.col("patient_id").alias("_id"))
        again = now.merged("stg_patients", among(now.rows("stg_patients"), "patient_id", ids))
        stats = partials.patient_stats(counted.drop("_gen").join(ids.hint("merge"), F.col("patient_id") == F.col("_id"), "left_semi"))
        return M.dim_patients(again, None, as_of_date, stats=stats.hint("merge"))

    def count_and_build() -> None:
        now.append(DAYS, days())
        now.append("dim_patients", dimension())

    jobs = [count_and_build] if "dim_patients" in now.marts else []
    for m in now.facts:
        mart, build = FACT_OF[m]
        jobs.append(lambda m=m, mart=mart, build=build: now.append(mart, build(changed(m, resent), patients)))
    _side_by_side(jobs)
    _note(now, list(loads), True)
    return now


def compact(spark: SparkSession, root: str, buckets: int | None = None) -> State:
    """Fold all generations into one row per key, in a new era.  Versions of
    earlier eras stay readable."""
    before, now = _begin(spark, root, buckets, new_era=True)
    if before is None:
        raise LookupError(f"no state under {root}")
    tables = {m: before.merged(m, before.rows(m).withColumn("_at", F.col("_pos"))).withColumnRenamed("_at", "_pos") for m in now.models}
    tables |= {m: before.merged(m, before.rows(m)) for m in now.marts}
    if now.facts:
        tables[LINKS] = before.rows(LINKS).drop("_gen").distinct()
    if "dim_patients" in now.marts:
        tables[DAYS] = partials.visit_days(None, before.staging("stg_encounters"))
    _side_by_side([lambda t=t, df=df: now.append(t, df) for t, df in tables.items()])
    held = _log(spark, root).where("completed and load is not null").groupBy("load").agg(F.max_by("n", "gen").alias("n")).collect()
    _note(now, [(r["load"], r["n"]) for r in held], True)
    return now


def audit(state: State, checks: list[Check], as_of_date=None, dedup_allergies: bool = False) -> DataFrame:
    """The report of ``quality.audit`` over the state's tables, from suspects.

    A reader's merge leaves one row per key, so ``unique`` on it holds.  The
    conditions on single rows are pushed into the scan, where statistics skip
    what cannot fail them; only keys with a failing row of any generation are
    merged, to see whether that row is the newest.  Tables that are not
    merged, and ``relationships``, are audited as a whole."""
    whole = [c for c in checks if c.test == "relationships" or not (c.model not in STAGING_SPECS or STAGING_SPECS[c.model]["dedup"] or dedup_allergies)]
    parts = [quality.audit(state.tables(as_of_date, dedup_allergies), whole)] if whole else []
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        if c not in whole:
            by_model.setdefault(c.model, []).append(c)
    for model, cs in by_model.items():
        if any(c.test == "unique" and c.column != KEYS[model] for c in cs):
            raise ValueError(f"unique is held by the key of {model} only")
        rows, key = state.rows(model), KEYS[model]
        row_checks = [(f"c{i}", quality.row_condition(c)) for i, c in enumerate(cs) if c.test != "unique"]
        suspects = rows.where(reduce(Column.__or__, [x for _, x in row_checks], F.lit(False))).select(F.col(key).alias("_id")).distinct()
        now = state.merged(model, among(rows, key, suspects), dedup_allergies)
        counts = now.agg(F.lit(0).alias("none"), *[F.count_if(x).alias(n) for n, x in row_checks])
        counts = counts.select(*[F.col(f"c{i}") if c.test != "unique" else F.lit(0).alias(f"c{i}") for i, c in enumerate(cs)])
        parts.append(quality.stacked(model, counts, [(c.test, c.column, f"c{i}") for i, c in enumerate(cs)]))
    return reduce(DataFrame.unionByName, parts)
