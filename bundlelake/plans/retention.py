"""What nobody reads any more below a lake's root.

Nothing is overwritten in place, so failed versions, refused or replaced
landing generations and folded state eras stay until they are swept.  A
folder is reachable if a reader or a run can still get to it: the current
version and the ``keep`` published before it, versions that are being built
or could be resumed or promoted, and the landing generation and state eras
that these stand for.  ``unreachable`` lists the rest, ``sweep`` removes it
(a dry run unless told otherwise; no run may be under way).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlelake.plans import versions as V
from bundlelake.sources import landing as L

SCHEMA = "kind string, name string, path string, reason string"


def version_states(spark: SparkSession, root: str, keep: int = 1) -> DataFrame:
    """``(label, reason)`` of every label; ``reason`` is null where the
    version is reachable."""
    labels = V.list_versions(spark, root)
    reports = None
    for r in labels.select("label").collect():  # one row per version
        one = V.audit_report(spark, root, r["label"]).agg(F.coalesce(F.bool_or("final"), F.lit(False)).alias("final"),
                                                          F.count_if(F.col("violations") > 0).alias("failed"))
        one = one.withColumn("label", F.lit(r["label"]))
        reports = one if reports is None else reports.unionByName(one)
    if reports is None:
        return spark.createDataFrame([], "label string, reason string")
    newest = [r["label"] for r in labels.where("published").orderBy(F.col("published_at").desc()).limit(keep + 1).collect()]
    reason = (F.when(F.col("label").isin(newest), F.lit(None)).when(F.col("published"), "replaced")
              .when(F.col("final") & (F.col("failed") > 0), "failed its audit"))
    return labels.select("label", "published").join(reports, "label").select("label", reason.alias("reason"))


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly in ``path``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory())


def unreachable(spark: SparkSession, root: str, keep: int = 1) -> DataFrame:
    """``(kind, name, path, reason)`` of the folders that can go.  ``keep``:
    published versions kept beside the current one."""
    base = root.rstrip("/")
    out, states = [], version_states(spark, base, keep).collect()
    gone = {r["label"] for r in states if r["reason"]}
    there = set(_folders(spark, f"{base}/versions"))
    out += [("version", r["label"], f"{base}/versions/{r['label']}", r["reason"]) for r in states if r["reason"] and r["label"] in there]

    now = L.generation(spark, f"{base}/landing")
    held = {now}  # generations and eras that versions stand for
    eras: dict[str, set[str]] = {}
    for r in states:
        kept = None if r["label"] in gone else L.read_or_empty(spark, V.version_path(base, r["label"], "_state"), V.STATE_SCHEMA).first()
        if kept is not None:
            from bundlelake.plans.current import at_generation
            state = at_generation(spark, kept["state_root"], kept["gen"])
            held.add(state.root.rsplit("/", 1)[-1])
            eras.setdefault(state.root, set()).add(state.era)
    for g in _folders(spark, f"{base}/landing"):
        if not g.startswith("_") and g != now:
            out.append(("landing", g, f"{base}/landing/{g}", "not the current generation"))
    for g in _folders(spark, f"{base}/typed_entries"):
        if g.removesuffix("-stream") != now:
            out.append(("typed entries", g, f"{base}/typed_entries/{g}", "not the current generation"))
    for g in _folders(spark, f"{base}/current"):
        state_root = f"{base}/current/{g}"
        if g not in held:
            out.append(("state", g, state_root, "no version stands for it"))
            continue
        from bundlelake.plans.current import at_generation
        newest = at_generation(spark, state_root)
        used = eras.get(state_root, set()) | ({newest.era} if newest is not None else set())
        out += [("state era", f"{g}/{e}", f"{state_root}/state/{e}", "folded") for e in _folders(spark, f"{state_root}/state")
                if newest is not None and not e.startswith("_") and e not in used]
    return spark.createDataFrame(out, SCHEMA)


def sweep(spark: SparkSession, root: str, keep: int = 1, dry_run: bool = True) -> DataFrame:
    """The unreachable folders; with ``dry_run=False`` they are removed.  The
    logs stay, so a label that was published stays taken."""
    found = unreachable(spark, root, keep).collect()  # one row per folder
    for r in found if not dry_run else []:
        at = spark._jvm.org.apache.hadoop.fs.Path(r["path"])
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return spark.createDataFrame([tuple(r) for r in found], SCHEMA)
