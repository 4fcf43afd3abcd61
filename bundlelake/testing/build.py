"""Composition of the whole model graph for one landing table.

``Build`` wires landing -> typed entries -> staging -> marts.  The typed
entries (parse + explode + per-type extraction, one pass) can be a lazy
DataFrame or a written table; ``Build.from_tables`` writes the fixture
landing and its typed entries once per session to the shared checkpoint
folder, as a scheduled job stores its landing and parsed layers, and
every model then reads Parquet with partition and column pruning.  The
bundles are parsed whole, but only the columns of models that are asked
for are extracted.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlelake.operators import marts as M
from bundlelake.operators.entries import bundle_entries
from bundlelake.operators.staging import model_types, stage_typed, typed_entries, write_typed
from bundlelake.plans import versions as V
from bundlelake.schemas import STAGING_SPECS
from bundlelake.session import scratch_path
from bundlelake.testing.fixtures import AS_OF_DATE, LOAD1_TS, LOAD2_TS, fixture_landing

_WRITTEN: dict = {}
LOAD_TS = {1: LOAD1_TS, 2: LOAD2_TS}


class Build:
    def __init__(self, spark: SparkSession, landing: DataFrame, as_of_date=AS_OF_DATE,
                 on_malformed: str = "fail", typed: Callable[..., DataFrame] | None = None):
        """``typed``: gives the typed entries of the models it is called with."""
        self.spark = spark
        self.landing = landing
        self.as_of_date = as_of_date
        self.on_malformed = on_malformed
        self._typed = typed or (lambda *models: typed_entries(model_types(bundle_entries(landing, on_malformed), models), on_malformed, models))
        self._layers_key: tuple = (uuid.uuid4().hex,)
        self._staging: dict[str, DataFrame] = {}
        self._marts: dict[str, DataFrame] = {}

    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str, loads: tuple[int, ...] = (1, 2), **kw) -> "Build":
        """Model graph over fixture bundles derived from the driver tables."""
        out = cls(spark, _of_loads(written_landing(spark, sf_dir), loads),
                  typed=lambda *models: _of_loads(written_typed(spark, sf_dir, *models), loads), **kw)
        out._layers_key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), tuple(loads), str(out.as_of_date))
        return out

    @property
    def typed(self) -> DataFrame:
        """Typed entries of all models."""
        return self._typed(*STAGING_SPECS)

    def typed_for(self, mart: str) -> DataFrame:
        """Typed entries of the staging models a mart reads."""
        return self._typed(*[m for m in STAGING_SPECS if m in M.sources(mart)])

    def _stage(self, *models: str) -> dict[str, DataFrame]:
        """Staging models whose entries are extracted in one pass."""
        new = [m for m in models if m not in self._staging]
        if new:
            typed = self._typed(*new)
            self._staging |= {m: stage_typed(typed, m) for m in new}
        return {m: self._staging[m] for m in models}

    def stg(self, model: str) -> DataFrame:
        return self._stage(model)[model]

    @property
    def staging(self) -> dict[str, DataFrame]:
        return self._stage(*STAGING_SPECS)

    def mart(self, name: str) -> DataFrame:
        return self.marts_of(name)[name]

    def marts_of(self, *names: str) -> dict[str, DataFrame]:
        """Marts whose sources are extracted in one pass."""
        sources = {n: M.sources(n) for n in names}
        self._stage(*[m for m in STAGING_SPECS if any(m in s for s in sources.values())])
        for name in names:
            if name not in self._marts:
                self._marts[name] = M.build_mart(name, self._stage(*sources[name]), self.as_of_date)
        return {n: self._marts[n] for n in names}

    @property
    def marts(self) -> dict[str, DataFrame]:
        return self.marts_of(*M.MART_KEYS)

    def tables(self) -> dict[str, V.Table]:
        """All tables for ``versions.write_tables``: the marts are built from
        the staging models that it has written."""
        return self.staging | {m: partial(M.build_mart, m, as_of_date=self.as_of_date) for m in M.MART_KEYS}

    def layers(self, *names: str) -> dict[str, DataFrame]:
        """The named tables (default: all), each layer written before the next
        reads it (each table once per session for fixture tables).  A mart has
        the staging models it reads written before it, and no others."""
        names = names or (*STAGING_SPECS, *M.MART_KEYS)
        there = _WRITTEN.setdefault(("layers", *self._layers_key), {})
        read = {m for n in names if n not in there for m in ((n,) if n in STAGING_SPECS else M.sources(n)) if m not in there}
        self._stage(*[m for m in STAGING_SPECS if m in read])

        def written(name: str) -> DataFrame:
            if name not in there:
                if name in STAGING_SPECS:
                    df = self.stg(name)
                else:
                    df = M.build_mart(name, {m: written(m) for m in M.sources(name)}, self.as_of_date)
                at = scratch_path(self.spark, f"layers/{name}")
                df.write.parquet(at)
                there[name] = at
            return self.spark.read.parquet(there[name])

        return {m: written(m) for m in names}


def write_landing(landing: DataFrame, root: str) -> DataFrame:
    landing.write.mode("overwrite").parquet(f"{root}/landing")
    return landing.sparkSession.read.parquet(f"{root}/landing")


def write_landing_and_typed(spark: SparkSession, landing: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    written = write_landing(landing, root)
    write_typed(typed_entries(model_types(bundle_entries(written))), f"{root}/typed_entries")
    return written, spark.read.parquet(f"{root}/typed_entries")


def written_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture landing, written once per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key in _WRITTEN:
        return spark.read.parquet(f"{_WRITTEN[key]}/landing")
    if ("landing", *key) not in _WRITTEN:
        root = scratch_path(spark, "fixture")
        write_landing(fixture_landing(spark, sf_dir), root)
        _WRITTEN["landing", *key] = root
    return spark.read.parquet(f"{_WRITTEN['landing', *key]}/landing")


def written_typed(spark: SparkSession, sf_dir: str, *models: str) -> DataFrame:
    """Typed entries of the given models of the whole fixture landing, written
    once per session and input.  Bundles are parsed and exploded whole; the
    columns extracted are those that are asked for.  Where the table of all
    models is there, it is read instead."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _WRITTEN and set(models) == set(STAGING_SPECS):
        written_fixture(spark, sf_dir)
    if key in _WRITTEN:
        return spark.read.parquet(f"{_WRITTEN[key]}/typed_entries")
    there = _WRITTEN.setdefault(("typed", *key), {})
    new = [m for m in models if m not in there]
    if new:
        at = scratch_path(spark, "fixture-typed")
        typed = typed_entries(model_types(bundle_entries(written_landing(spark, sf_dir)), new), models=new)
        write_typed(typed, at)
        there |= dict.fromkeys(new, (at, typed.schema))  # a table without entries has no schema of its own
    tables = [spark.read.schema(schema).parquet(at) for at, schema in dict(there[m] for m in models).items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def _of_loads(df: DataFrame, loads: tuple[int, ...]) -> DataFrame:
    """Some of the loads are the rows with their load times: nothing is built
    and parsed again for them."""
    if set(loads) == set(LOAD_TS):
        return df
    return df.where(F.col("ingestion_timestamp").isin([F.lit(LOAD_TS[x]).cast("timestamp") for x in loads]))


def written_fixture(spark: SparkSession, sf_dir: str, loads: tuple[int, ...] = (1, 2)) -> tuple[DataFrame, DataFrame]:
    """Fixture landing + typed entries of all models, written once per session
    and input."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _WRITTEN:
        root = _WRITTEN.get(("landing", *key))
        if root:
            write_typed(typed_entries(model_types(bundle_entries(written_landing(spark, sf_dir)))), f"{root}/typed_entries")
        else:
            root = scratch_path(spark, "fixture")
            write_landing_and_typed(spark, fixture_landing(spark, sf_dir), root)
        _WRITTEN[key] = root
    root = _WRITTEN[key]
    return tuple(_of_loads(spark.read.parquet(f"{root}/{x}"), loads) for x in ("landing", "typed_entries"))
