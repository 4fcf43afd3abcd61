"""Typed staging tables: flatten one resource type with a column spec,
then keep the latest copy of each resource id."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bundlelake.functions import json as J
from bundlelake.operators.entries import entries_of_type
from bundlelake.schemas import STAGING_SPECS


def _cast(kind: str, s: Column, lenient: bool) -> Column:
    if kind == "str":
        return s
    if kind == "ref":
        return J.strip_ref(s)
    if kind not in J.CASTS:
        raise ValueError(f"unknown extraction kind {kind!r}")
    return J.CASTS[kind](s, lenient)


def extract(kind: str, entry: Column, path: str, text: Column | None = None, lenient: bool = False) -> Column:
    """Typed value at ``path``; ``text`` is the raw extracted string when
    the caller already projected it (see ``typed_entries``).  ``lenient``
    makes a bad value NULL instead of an error (see ``cast_rejects``)."""
    return _cast(kind, J.json_scalar(entry, path) if text is None else J.guard_scalar(text, entry, path), lenient)


def flatten(entries: DataFrame, columns: list[tuple[str, str, str]],
            processed_at: Column | None = None) -> DataFrame:
    """Project JSON paths of each entry into typed columns, then the
    metadata tail every staging model carries.  Each path is walked once
    (raw text), then guarded and cast (see ``typed_entries``)."""
    e = F.col("entry")
    raw = [F.try_variant_get(e, path, "string").alias(f"_t{i}") for i, (_, path, _) in enumerate(columns)]
    texts = entries.select("file_path", "ingestion_timestamp", "pos", "entry", *raw)
    cols = [extract(kind, e, path, F.col(f"_t{i}")).alias(name) for i, (name, path, kind) in enumerate(columns)]
    tail = [
        F.col("file_path"),
        F.col("ingestion_timestamp"),
        F.col("ingestion_timestamp").alias("ingested_at"),
        (processed_at if processed_at is not None else F.current_timestamp()).alias("dbt_processed_at"),
    ]
    # pos is kept (hidden) for the dedup tie-break and dropped afterwards
    return texts.select(*cols, *tail, F.col("pos").alias("_pos"))


def dedup_latest(df: DataFrame, key: str, order_by: list[Column] | None = None) -> DataFrame:
    """Keep one row per ``key``: newest ``ingestion_timestamp``; ties broken
    by ``file_path`` then entry position (both descending) so the winner
    is deterministic.

    ``row_number() = 1`` over a key window is planned with a partial
    ``WindowGroupLimit`` before the shuffle, so a hot id re-sent many
    times is cut to one row per map task before it reaches the exchange.
    """
    order = order_by or [F.col("ingestion_timestamp").desc(), F.col("file_path").desc(),
                         F.col("_pos").desc()]
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def stage(entries: DataFrame, model: str, dedup: bool | None = None,
          processed_at: Column | None = None) -> DataFrame:
    """Build one staging model (``stg_*``) from the shared entries frame."""
    spec = STAGING_SPECS[model]
    df = flatten(entries_of_type(entries, spec["resource_type"]), spec["columns"], processed_at)
    if spec["dedup"] if dedup is None else dedup:
        df = dedup_latest(df, spec["key"])
    return df.drop("_pos")



def model_types(entries: DataFrame, models: Iterable[str] = STAGING_SPECS) -> DataFrame:
    """Entries of the staging models' resource types (others are counted by
    ``entry_type_counts``, not stored)."""
    return entries.where(F.col("resource_type").isin([STAGING_SPECS[m]["resource_type"] for m in models]))


def write_typed(typed: DataFrame, path: str, *by: str, mode: str = "overwrite", dynamic: bool = False) -> None:
    """Write typed entries partitioned by ``resource_type`` (below ``by``),
    gathered by partition first: few files per run, large types split."""
    keys = [*by, "resource_type"]
    w = typed.hint("rebalance", *[F.col(k) for k in keys]).write.mode(mode).partitionBy(*keys)
    (w.option("partitionOverwriteMode", "dynamic") if dynamic else w).parquet(path)


def cast_rejects(entries: DataFrame) -> DataFrame:
    """``(file_path, ingestion_timestamp, pos, resource_type, column, text)``
    of every value that its column's cast does not accept."""
    e = F.col("entry")
    found = None
    for spec in STAGING_SPECS.values():
        values = []
        for name, path, kind in spec["columns"]:
            if kind in J.CASTS:
                text = J.json_scalar(e, path)
                values.append(F.when(text.isNotNull() & _cast(kind, text, True).isNull(),
                                     F.struct(F.lit(name).alias("column"), text.alias("text"))))
        if values:
            hit = F.col("resource_type") == F.lit(spec["resource_type"])
            found = F.when(hit, F.array(*values)) if found is None else found.when(hit, F.array(*values))
    return (entries.select("file_path", "ingestion_timestamp", "pos", "resource_type", F.explode(found).alias("r"))
            .where(F.col("r").isNotNull()).select("file_path", "ingestion_timestamp", "pos", "resource_type", "r.column", "r.text"))


def typed_entries(entries: DataFrame, on_malformed: str = "fail", models: Iterable[str] = STAGING_SPECS) -> DataFrame:
    """Flatten every resource type (or those of the given models) in one pass
    over the parsed entries.

    One struct column per staging model holds that model's typed columns;
    it is filled only for entries of its type (``CASE`` is evaluated
    lazily, so each entry pays only for its own paths).  Written
    partitioned by ``resource_type`` this is the one table all staging
    models read: the JSON is parsed and walked once, no VARIANT is
    stored, and each model reads one partition and one struct (nested
    column pruning).  A value that a cast does not accept fails the run, or
    with ``'quarantine'`` is NULL and a row of ``cast_rejects``.

    Two projections: the first walks each path once (raw text), the
    second applies the scalar guard and casts to those texts.  In one
    projection the guard's two references to the text would each walk
    the variant (no common-subexpression reuse inside conditional
    branches).  The texts are flat columns: the optimizer leaves two
    adjacent projections apart when the second refers more than once to
    what is costly in the first, while fields of a struct are merged.
    Plain projections are compiled in small methods however many paths
    there are (a generator between them is evaluated expression by
    expression).
    """
    e = F.col("entry")
    rt = F.col("resource_type")
    specs = {m: STAGING_SPECS[m] for m in models}
    raw = []
    for model, spec in specs.items():
        raw += [F.when(rt == F.lit(spec["resource_type"]), F.try_variant_get(e, path, "string")).alias(f"_{model}_{name}")
                for name, path, _ in spec["columns"]]
    texts = entries.select("file_path", "ingestion_timestamp", "pos", "resource_type", "entry", *raw)
    structs = []
    for model, spec in specs.items():
        fields = [extract(kind, e, path, F.col(f"_{model}_{name}"), on_malformed == "quarantine").alias(name)
                  for name, path, kind in spec["columns"]]
        structs.append(F.when(rt == F.lit(spec["resource_type"]), F.struct(*fields)).alias(model))
    return texts.select("file_path", "ingestion_timestamp", "pos", "resource_type", *structs)


def stage_typed(typed: DataFrame, model: str, dedup: bool | None = None,
                processed_at: Column | None = None, keep_pos: bool = False) -> DataFrame:
    """A staging model from the typed-entries table (see ``typed_entries``);
    ``keep_pos`` keeps the entry's position, the last tie-break of copies."""
    spec = STAGING_SPECS[model]
    df = (typed.where(F.col("resource_type") == F.lit(spec["resource_type"]))
          .select(*[F.col(f"{model}.{name}").alias(name) for name, _, _ in spec["columns"]],
                  F.col("file_path"), F.col("ingestion_timestamp"),
                  F.col("ingestion_timestamp").alias("ingested_at"),
                  (processed_at if processed_at is not None else F.current_timestamp()).alias("dbt_processed_at"),
                  F.col("pos").alias("_pos")))
    if spec["dedup"] if dedup is None else dedup:
        df = dedup_latest(df, spec["key"])
    return df if keep_pos else df.drop("_pos")
