"""Parse bundle text once and explode it to one row per entry.

The reference re-parses the whole landing table in each of its eight
staging models.  Here the parse + explode runs once; the result carries
``resource_type`` so a pipeline can write it partitioned by type and
each staging model then reads only its own partition (partition pruning
instead of a filter over every entry).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundlelake.functions.json import guard_scalar

TYPE_PATH = "$.resource.resourceType"


def parse_bundles(landing: DataFrame, on_malformed: str = "fail") -> DataFrame:
    """Add ``bundle`` (VARIANT) parsed from ``data``.

    ``on_malformed='fail'`` raises on bad JSON like the reference build;
    ``'quarantine'`` turns bad rows into NULL bundles (see ``malformed_bundles``).
    """
    if on_malformed == "fail":
        parsed = F.parse_json("data")
    elif on_malformed == "quarantine":
        parsed = F.try_parse_json("data")
    else:
        raise ValueError(f"on_malformed must be 'fail' or 'quarantine', not {on_malformed!r}")
    return landing.withColumn("bundle", parsed)


def malformed_bundles(landing: DataFrame) -> DataFrame:
    """``(file_path, ingestion_timestamp, reason)`` of rows whose text is not
    valid JSON or whose ``entry`` is there but no array (the quarantine side)."""
    bundle = F.try_parse_json("data")
    kind = F.schema_of_variant(F.try_variant_get(bundle, "$.entry", "variant"))
    reason = (F.when(bundle.isNull(), F.lit("not JSON"))
              .when(kind.isNotNull() & ~kind.rlike("^(ARRAY|VOID)"), F.lit("entry is not an array")))
    return (landing.where(F.col("data").isNotNull()).withColumn("reason", reason).where(F.col("reason").isNotNull())
            .select("file_path", "ingestion_timestamp", "reason"))


def bundle_entries(landing: DataFrame, on_malformed: str = "fail") -> DataFrame:
    """``CROSS JOIN UNNEST(CAST(json_extract(bundle, '$.entry') AS ARRAY(JSON)))``.

    One row per entry with its position.  A missing or null ``entry`` gives
    no rows; one that is no array fails like the reference's cast, or with
    ``'quarantine'`` gives no rows and is a row of ``malformed_bundles``.
    """
    parsed = parse_bundles(landing, on_malformed)
    get = F.variant_get if on_malformed == "fail" else F.try_variant_get
    exploded = parsed.select(
        "file_path", "ingestion_timestamp",
        F.posexplode(get("bundle", "$.entry", "array<variant>")).alias("pos", "entry"))
    # the type's text is a projection of its own, so that its guard does not walk the entry again
    typed = exploded.withColumn("_type", F.try_variant_get("entry", TYPE_PATH, "string"))
    return typed.select(
        "file_path", "ingestion_timestamp", "pos",
        guard_scalar(F.col("_type"), "entry", TYPE_PATH).alias("resource_type"),
        "entry")


def entries_of_type(entries: DataFrame, resource_type: str) -> DataFrame:
    """Resource-type filter; a partition filter when ``entries`` is written
    partitioned by ``resource_type``."""
    return entries.where(F.col("resource_type") == F.lit(resource_type))


def entry_type_counts(entries: DataFrame) -> DataFrame:
    return entries.groupBy("resource_type").agg(F.count(F.lit(1)).alias("n_entries"))
