"""Write-audit-publish with labelled versions on plain Parquet.

Layout under ``root`` (a shared folder):

* ``versions/<label>/<table>/``  - the tables of one build, ``_audit`` its report; an incremental
  build has ``_state`` instead, the generation of the current-state tables (``plans.current``)
* ``_write_log/``                - append-only Parquet log ``(label, table, written_at)``
* ``_publish_log/``              - append-only Parquet log ``(label, published_at)``

A build is written under a new label, audited from what was written, and
only then published by appending one log row; a label is used once.  Readers resolve the
current label as the newest log row, so a failed audit (or a crashed
write) never changes what readers see.  Nothing that was audited to the end
is overwritten; a build that broke off before can be resumed under its label
(``claim_label(resume=True)``): it starts anew and replaces what is there.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlelake.operators.quality import ALL_CHECKS, audit
from bundlelake.sources.landing import read_or_empty

LOG_SCHEMA = "label string, published_at timestamp"
WRITE_LOG_SCHEMA = "label string, table string, written_at timestamp"
STATE_SCHEMA = "state_root string, gen long, as_of string, dedup_allergies boolean"
AT_ONCE = 4  # tables written side by side: the last tasks of one leave cores idle
REPORT_SCHEMA = "model string, test string, column string, violations long, final boolean"


class LabelTaken(ValueError):
    """A build of that label was begun before (or, when resuming, audited to the end)."""


class NotPublishable(ValueError):
    """The label was not written, or its audit did not pass."""


def version_path(root: str, label: str, table: str | None = None) -> str:
    p = f"{root.rstrip('/')}/versions/{label}"
    return f"{p}/{table}" if table else p


def claim_label(spark: SparkSession, root: str, label: str, resume: bool = False) -> bool:
    """Take a label for a new build, before anything is written under it.
    With ``resume`` a label whose build broke off (no audit to the end) is
    taken again, as when a scheduler retries a task; the earlier run must
    have ended.  Returns whether something was begun under it before."""
    live = publish_log(spark, root).where(F.col("label") == label).limit(1).count() > 0  # also of a version since swept
    begun = live or write_log(spark, root).where(F.col("label") == label).limit(1).count() > 0
    if live or (begun and not (resume and not audit_report(spark, root, label).where("final").limit(1).count())):
        raise LabelTaken(f"label {label!r} has been used under {root}")
    if not begun:
        _log_written(spark, root, label, [None])
    return begun


def _log_written(spark: SparkSession, root: str, label: str, names) -> None:
    (spark.createDataFrame([(label, t) for t in names], "label string, table string")
     .withColumn("written_at", F.current_timestamp())
     .write.mode("append").parquet(f"{root.rstrip('/')}/_write_log"))


Table = DataFrame | Callable[[dict[str, DataFrame]], DataFrame]


def write_tables(tables: dict[str, Table], root: str, label: str, resumed: bool = False) -> dict[str, DataFrame]:
    """Write tables under a claimed label; returns them as read back.  Only a
    ``resumed`` build replaces tables that are there.  A table that is built
    from others of the version is a function of those: it is written after
    them and reads them as they were written."""
    out: dict[str, DataFrame] = {}

    def one(name: str, df: DataFrame) -> DataFrame:
        p = version_path(root, label, name)
        df.write.mode("overwrite" if resumed else "errorifexists").parquet(p)
        return df.sparkSession.read.parquet(p)

    with ThreadPoolExecutor(AT_ONCE) as pool:
        for late in (False, True):  # the first error is raised when those under way have ended
            begun = {n: pool.submit(one, n, t(out) if late else t) for n, t in tables.items() if callable(t) == late}
            out |= {n: x.result() for n, x in begun.items()}
    if tables:
        _log_written(next(iter(out.values())).sparkSession, root, label, list(tables))
    return {n: out[n] for n in tables}


def write_log(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, f"{root.rstrip('/')}/_write_log", WRITE_LOG_SCHEMA)


def publish_log(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, f"{root.rstrip('/')}/_publish_log", LOG_SCHEMA)


def read_version(spark: SparkSession, root: str, table: str, label: str | None = None) -> DataFrame:
    """A table as of ``label`` (default: the current published label)."""
    label = label or current_label(spark, root)
    if label is None:
        raise LookupError(f"nothing published under {root}")
    kept = read_or_empty(spark, version_path(root, label, "_state"), STATE_SCHEMA).first()
    if kept is None:
        return spark.read.parquet(version_path(root, label, table))
    from bundlelake.plans.current import at_generation
    state = at_generation(spark, kept["state_root"], kept["gen"])
    return state.tables(kept["as_of"], kept["dedup_allergies"])[table]


def point_to_state(spark: SparkSession, root: str, label: str, state_root: str, gen: int, as_of_date, dedup_allergies: bool,
                   resumed: bool = False) -> None:
    """Make a claimed label stand for a generation of the state tables."""
    (spark.range(1).select(F.lit(state_root).alias("state_root"), F.lit(gen).cast("long").alias("gen"), F.coalesce(F.lit(as_of_date).cast("date"), F.current_date()).cast("string").alias("as_of"),
                           F.lit(dedup_allergies).alias("dedup_allergies"))
     .write.mode("overwrite" if resumed else "errorifexists").parquet(version_path(root, label, "_state")))
    _log_written(spark, root, label, ["_state"])


def current_label(spark: SparkSession, root: str) -> str | None:
    row = publish_log(spark, root).agg(F.max_by("label", "published_at").alias("l")).first()
    return row["l"] if row else None


def audit_report(spark: SparkSession, root: str, label: str) -> DataFrame:
    """The audit report(s) written with a version."""
    return read_or_empty(spark, version_path(root, label, "_audit"), REPORT_SCHEMA)


def publish(spark: SparkSession, root: str, label: str) -> None:
    """Make a written version current: it must have been audited, to the end
    and without violations."""
    report = audit_report(spark, root, label).agg(
        F.count("*").alias("n"), F.count_if(F.col("violations") > 0).alias("bad"), F.coalesce(F.bool_or("final"), F.lit(False)).alias("final")).first()
    if not report["final"] or report["bad"]:
        raise NotPublishable(f"label {label!r}: {report['n']} tests on record, {report['bad']} failed, {'' if report['final'] else 'not '}audited to the end")
    spark.range(1).select(F.lit(label).alias("label"), F.current_timestamp().alias("published_at")) \
        .write.mode("append").parquet(f"{root.rstrip('/')}/_publish_log")


def list_versions(spark: SparkSession, root: str) -> DataFrame:
    """Every label -> ``(label, tables, written_at, published_at, published,
    current)``, newest first.  A label without tables is a build that broke off."""
    written = (write_log(spark, root).groupBy("label")
               .agg(F.sort_array(F.collect_set("table")).alias("tables"), F.max("written_at").alias("written_at")))
    pub = publish_log(spark, root).groupBy("label").agg(F.max("published_at").alias("published_at"))
    cur = publish_log(spark, root).agg(F.max_by("label", "published_at").alias("_current"))
    out = written.join(pub, "label", "full_outer")
    return (out.withColumn("published", F.col("published_at").isNotNull())
            .withColumn("current", F.col("label") == cur.select("_current").scalar())
            .withColumn("current", F.coalesce("current", F.lit(False)))
            .orderBy(F.col("written_at").desc_nulls_last(), F.col("label")))


def audit_step(spark: SparkSession, root: str, label: str, tables: dict[str, DataFrame], checks, final: bool = True,
               first: bool = True) -> int:
    """Audit written tables once and keep the report with the version;
    returns how many tests failed.  ``final``: no further step follows;
    ``first``: none came before (a report of a build that broke off goes)."""
    return keep_report(spark, root, label, audit(tables, checks), final, first)


def keep_report(spark: SparkSession, root: str, label: str, report: DataFrame, final: bool = True, first: bool = True) -> int:
    (report.withColumn("final", F.lit(final)).coalesce(1)
     .write.mode("overwrite" if first else "append").parquet(version_path(root, label, "_audit")))
    return audit_report(spark, root, label).where("violations > 0").count()


def failed_models(spark: SparkSession, root: str, label: str) -> set[str]:
    """Models of the report's failed tests (at most one per model)."""
    return {r["model"] for r in audit_report(spark, root, label).where("violations > 0").select("model").distinct().collect()}


def outcome(spark: SparkSession, root: str, label: str) -> DataFrame:
    """The version's report with ``label`` and ``published``."""
    live = publish_log(spark, root).where(F.col("label") == label).limit(1).count() > 0
    return (audit_report(spark, root, label).drop("final")
            .withColumn("label", F.lit(label)).withColumn("published", F.lit(live)))


def write_audit_publish(spark: SparkSession, tables: dict[str, Table], root: str, label: str,
                        checks=None, resume: bool = False) -> DataFrame:
    """Write a build under a new label, audit what was written, publish if
    every test passes (a failed audit leaves the current label as it is).
    Returns the audit report with ``label`` and ``published``."""
    resumed = claim_label(spark, root, label, resume)
    written = write_tables(tables, root, label, resumed)
    if not audit_step(spark, root, label, written, checks if checks is not None else ALL_CHECKS):
        publish(spark, root, label)
    return outcome(spark, root, label)
