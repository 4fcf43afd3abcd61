"""Raw bundle files -> landing table.

A raw-file *manifest* is a DataFrame ``(path, length, content)``; it comes
from a directory listing (``list_raw_files``, Spark's ``binaryFile``
source, which lists every file rather than one page; ``list_files``, tasks
that list folders and, if asked to, ZIP archives) or from any table
with the same columns.  Size and per-run limits are the caller's choice
(none by default); whatever a run leaves out because of its size or its
bytes is written to the landing table's ``_skipped`` table.

Layout of a landing table at ``root``: ``<generation>/outcome=landed`` with
the rows, ``<generation>/outcome=rejected`` with what the same writes could
not land (no bodies), ``_generations`` (one row per full refresh, the newest
names the current folder) and ``_skipped``, which holds each reject once.  A
full refresh writes a new generation and switches by one log row, so a crash
leaves readers on the old one.

Bodies are opened once: what is pending is found from the listing's metadata
alone, the scan of bodies starts at the oldest pending file (a filter that
the source applies before it opens a file), and one write sorts the files by
outcome, with the counts taken on the way.
"""

from __future__ import annotations

import fnmatch
import os
import re
import uuid
from urllib.parse import quote, unquote
from zipfile import ZipFile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bundlelake.schemas import LANDING_SCHEMA
from bundlelake.session import scratch_path

# The reference's per-file size limit and per-run file cap
# (to be asked for; no function applies them by itself).
MAX_FILE_BYTES = 3 * 1024 * 1024
MAX_FILES_PER_RUN = 100

FIRST_GENERATION = "g0"
SKIPPED_SCHEMA = "file_path string, length long, reason string, seen_at timestamp, modified_at timestamp"
REJECTED_SCHEMA = "file_path string, length long, reason string, ingestion_timestamp timestamp, modified_at timestamp"
NOT_UTF8, TOO_LARGE, NO_CONTENT = "not UTF-8", "too large", "no content"


def list_raw_files(spark: SparkSession, prefix: str, glob: str | None = "*.json", modified_after: str | None = None) -> DataFrame:
    """Recursive listing of ``prefix`` -> ``(path, length, modificationTime,
    content)``; ``modified_after`` prunes the listing of an hourly run (files
    with an older modification time are then not seen, so it is opt-in)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if modified_after:
        r = r.option("modifiedAfter", modified_after)
    return r.load(prefix)


LISTED_SCHEMA = "path string, modificationTime timestamp, length long"
BODY_BATCH = 16 << 20   # bytes of bodies a task hands on at once
BODY_TASK = 64 << 20    # bytes of bodies a task opens
ARCHIVED = "zip:"       # source path of a member: zip:<archive>!/<member>, both percent-encoded


def mounted(prefix: str) -> bool:
    """The prefix is a path in the executors' file system (a shared mount)."""
    return ":" not in prefix.split("/", 1)[0] or prefix.startswith("file:")


def _plain(path: str) -> str:
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else os.path.abspath(path)


def _hidden(name: str) -> bool:
    """What Spark's own listing leaves out."""
    return name.startswith(".") or name.endswith("._COPYING_") or (
        name.startswith("_") and "=" not in name and not name.startswith(("_metadata", "_common_metadata")))


def list_files(spark: SparkSession, prefix: str, glob: str | None = "*.json", modified_after: str | None = None,
               archives: str | None = None) -> DataFrame:
    """The listing of :func:`list_raw_files` without bodies, made by tasks and
    kept as Parquet: Spark's source holds every listed file in the driver,
    several times over.  One job per level of folders; a folder is read by
    one task, as a stream of names.  Other file systems than a shared mount
    are listed by Spark's source, bodies and all.

    ``archives``: names (a glob) of ZIP archives.  Their members are files of
    the folder the archive lies in, changed when the archive was; the column
    ``source_path`` tells where they are.  Each path is listed once, as
    changed last."""
    if not mounted(prefix):
        if archives:
            raise ValueError(f"archives are read from a shared mount, not from {prefix!r}")
        return list_raw_files(spark, prefix, glob, modified_after)
    at = scratch_path(spark, "listing")
    found = pa.schema([("path", pa.string()), ("modificationTime", pa.timestamp("us", tz="UTC")), ("length", pa.int64()),
                       ("folder", pa.bool_()), ("archive", pa.bool_())])
    members = pa.schema([*list(found)[:3], ("source_path", pa.string())])

    def handed_on(rows, schema):
        some = []
        for row in rows:
            some.append(row)
            if len(some) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)
                some = []
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)

    def entries_of(batches):
        for b in batches:
            for top in b.column(0).to_pylist():
                with os.scandir(top) as entries:
                    for x in entries:
                        if _hidden(x.name):
                            continue
                        folder = x.is_dir()
                        packed = bool(archives) and not folder and fnmatch.fnmatchcase(x.name, archives)
                        if not (folder or packed) and glob and not fnmatch.fnmatchcase(x.name, glob):
                            continue
                        st = x.stat()
                        yield x.path, st.st_mtime_ns // 1_000_000 * 1000, st.st_size, folder, packed

    def members_of(batches):
        for b in batches:
            for archive, changed in zip(b.column(0).to_pylist(), b.column(1).cast(pa.int64()).to_pylist()):
                with ZipFile(archive) as z:
                    for x in z.infolist():
                        parts = x.filename.strip("/").split("/")
                        if not x.is_dir() and not any(map(_hidden, parts)) and (not glob or fnmatch.fnmatchcase(parts[-1], glob)):
                            yield (f"{os.path.dirname(archive)}/{'/'.join(parts)}", changed, x.file_size,
                                   f"{ARCHIVED}{quote(archive)}!/{quote(x.filename)}")

    schema = f"{LISTED_SCHEMA}, folder boolean, archive boolean"
    folders, level = spark.createDataFrame([(_plain(prefix),)], "path string"), 0
    while level == 0 or not folders.isEmpty():
        tasks = spark.sparkContext.defaultParallelism if level else 1
        (folders.repartition(tasks).mapInArrow(lambda batches: handed_on(entries_of(batches), found), schema)
         .write.parquet(f"{at}/level={level}"))
        folders = spark.read.schema(schema).parquet(f"{at}/level={level}").where("folder").select("path")
        level += 1
    seen = spark.read.schema(f"{schema}, level int").parquet(at).where("not folder")
    out = seen.where("not archive").drop("folder", "archive", "level")
    if archives:
        packed = (seen.where("archive").select("path", "modificationTime").repartition(spark.sparkContext.defaultParallelism)
                  .mapInArrow(lambda batches: handed_on(members_of(batches), members), f"{LISTED_SCHEMA}, source_path string"))
        every = out.withColumn("source_path", F.concat(F.lit("file:"), "path")).unionByName(packed)
        last = F.max(F.struct("modificationTime", "source_path", "length")).alias("f")
        every.groupBy("path").agg(last).select("path", "f.modificationTime", "f.length", "f.source_path").write.parquet(f"{at}-members")
        out = spark.read.schema(f"{LISTED_SCHEMA}, source_path string").parquet(f"{at}-members")
    if modified_after:
        out = out.where(F.col("modificationTime") > F.lit(modified_after).cast("timestamp"))
    return out.withColumn("path", F.concat(F.lit("file:"), "path"))


def opened(files: DataFrame) -> DataFrame:
    """The bodies of listed files, read by the tasks that hand them on.  The
    names are dealt over as many tasks as their sizes ask for, those of one
    archive to the same task."""
    named = files if "source_path" in files.columns else files.withColumn("source_path", F.col("path"))
    named = named.select("path", "source_path", "length", "modificationTime")

    def read(batches):
        archive, at = None, None

        def body(name: str) -> bytes:
            nonlocal archive, at
            if not name.startswith(ARCHIVED):
                with open(_plain(name), "rb") as f:
                    return f.read()
            where, _, member = name.removeprefix(ARCHIVED).partition("!/")
            if where != at:
                if archive:
                    archive.close()
                archive, at = ZipFile(unquote(where)), where
            return archive.read(unquote(member))

        try:
            for b in batches:
                bodies, first, size = [], 0, 0
                for i, name in enumerate(b.column(1).to_pylist()):
                    bodies.append(body(name))
                    size += len(bodies[-1])
                    if size >= BODY_BATCH or i + 1 == b.num_rows:
                        part = b.slice(first, len(bodies))
                        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(bodies, pa.binary())], names=[*b.schema.names, "content"])
                        bodies, first, size = [], i + 1, 0
        finally:
            if archive:
                archive.close()

    spark = files.sparkSession
    total = named.agg(F.sum("length").alias("n")).first()["n"] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // BODY_TASK))
    return (named.repartition(tasks, F.substring_index("source_path", "!/", 1)).sortWithinPartitions("source_path")
            .mapInArrow(read, "path string, source_path string, length long, modificationTime timestamp, content binary"))


def relative_key(path: Column, prefix: str, key_prefix: str = "") -> Column:
    """``key_prefix`` + the part of ``path`` after ``prefix`` (scheme-insensitive)."""
    bare = prefix.split(":", 1)[-1] if ":" in prefix.split("/", 1)[0] else prefix
    bare = "/" + bare.lstrip("/").rstrip("/") + "/"
    return F.concat(F.lit(key_prefix), F.element_at(F.split(path, re.escape(bare), 2), 2))


def relative_paths(manifest: DataFrame, prefix: str, key_prefix: str = "") -> DataFrame:
    """Replace absolute listing paths by object keys; the listing path stays
    as ``source_path`` (where the listing has none of its own)."""
    named = manifest if "source_path" in manifest.columns else manifest.withColumn("source_path", F.col("path"))
    return named.withColumn("path", relative_key(F.col("path"), prefix, key_prefix))


def json_keys(manifest: DataFrame) -> DataFrame:
    """Keep object keys ending in ``.json`` (case-sensitive), no folders."""
    return manifest.where(F.col("path").endswith(".json") & ~F.col("path").endswith("/"))


def size_guard(manifest: DataFrame, max_bytes: int | None) -> DataFrame:
    """Skip files larger than ``max_bytes`` (a file of exactly the limit is kept)."""
    if max_bytes is None:
        return manifest
    return manifest.where(F.col("length") <= F.lit(max_bytes))


def pending(manifest: DataFrame, landing: DataFrame) -> DataFrame:
    """Files not yet in the landing table (keyed on path only, so a changed
    file under a known path is not read again)."""
    return manifest.join(landing.select("file_path"), manifest["path"] == F.col("file_path"), "left_anti")


def _valid(content: Column) -> Column:
    return F.is_valid_utf8(content.cast("string"))


def decode(manifest: DataFrame) -> DataFrame:
    """UTF-8 decode of accepted files -> ``(file_path, data)``."""
    return manifest.where(_valid(F.col("content"))).select(
        F.col("path").alias("file_path"), F.col("content").cast("string").alias("data"))


def decode_rejects(manifest: DataFrame) -> DataFrame:
    """Files that are not valid UTF-8."""
    return manifest.where(~_valid(F.col("content"))).select(F.col("path").alias("file_path"), "length")


def skipped(manifest: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``(file_path, length, reason)`` of the files a run cannot land.  Bodies
    of too large files are not read."""
    bad = decode_rejects(size_guard(manifest, max_bytes)).withColumn("reason", F.lit("not UTF-8"))
    if max_bytes is None:
        return bad
    return (manifest.where(F.col("length") > F.lit(max_bytes))
            .select(F.col("path").alias("file_path"), "length", F.lit("too large").alias("reason")).unionByName(bad))


def stamp(decoded: DataFrame, ingestion_timestamp=None) -> DataFrame:
    """One load timestamp for every row of a run."""
    ts = F.current_timestamp() if ingestion_timestamp is None else F.lit(str(ingestion_timestamp)).cast("timestamp")
    return decoded.select("file_path", "data", ts.alias("ingestion_timestamp"))


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """A Parquet table; an absent one reads as empty (create-if-absent)."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # noqa: BLE001 - path does not exist yet
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def generation(spark: SparkSession, root: str) -> str:
    """Name of the folder that holds the current rows."""
    log = read_or_empty(spark, f"{root.rstrip('/')}/_generations", "generation string, at timestamp")
    return log.agg(F.max_by("generation", "at").alias("g")).first()["g"] or FIRST_GENERATION


def data_path(spark: SparkSession, root: str) -> str:
    return landed_path(root, generation(spark, root))


def landed_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}/outcome=landed"


def read_landing(spark: SparkSession, root: str) -> DataFrame:
    """The landing table as of its current generation."""
    return read_or_empty(spark, data_path(spark, root), LANDING_SCHEMA)


def read_skipped(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, f"{root.rstrip('/')}/_skipped", SKIPPED_SCHEMA)


def append_landing(rows: DataFrame, root: str) -> None:
    """The one way rows reach a landing table, from batch and stream alike.
    Small inputs become few files (rebalance)."""
    (rows.select(*LANDING_SCHEMA.fieldNames()).hint("rebalance")
     .write.mode("append").parquet(data_path(rows.sparkSession, root)))


def record_skipped(files: DataFrame, root: str, seen_at, n: int | None = None) -> None:
    """Add what is not on record yet (a file rejected again as it was adds
    nothing).  ``n``: how many files these are, where that is known."""
    if n == 0:
        return
    known = read_skipped(files.sparkSession, root).select(
        F.col("file_path").alias("_path"), F.col("length").alias("_length"), F.col("reason").alias("_reason"), F.col("modified_at").alias("_at"))
    same = ((F.col("file_path") == F.col("_path")) & F.col("length").eqNullSafe(F.col("_length")) & (F.col("reason") == F.col("_reason"))
            & F.col("modified_at").eqNullSafe(F.col("_at")))
    (files.join(known, same, "left_anti").withColumn("seen_at", F.lit(str(seen_at)).cast("timestamp"))
     .select("file_path", "length", "reason", "seen_at", "modified_at")
     .hint("rebalance").write.mode("append").parquet(f"{root.rstrip('/')}/_skipped"))


def _modified(manifest: DataFrame) -> Column:
    """When a file was changed last, where the manifest knows it."""
    return F.col("modificationTime") if "modificationTime" in manifest.columns else F.lit(None).cast("timestamp")


def outcomes(readable: DataFrame, ingestion_timestamp, large: DataFrame | None = None) -> DataFrame:
    """One row per file of a run: its text, or the reason why it has none.
    Of ``large`` (too large to be taken) bodies are not read."""
    text = F.try_validate_utf8(F.col("content").cast("string"))
    reason = F.when(F.col("content").isNull(), NO_CONTENT).when(text.isNull(), NOT_UTF8)
    files = readable.select(F.col("path").alias("file_path"), text.alias("data"), "length", _modified(readable).alias("modified_at"),
                            reason.alias("reason"))
    if large is not None:
        files = files.unionByName(large.select(F.col("path").alias("file_path"), F.lit(None).cast("string").alias("data"), "length",
                                               _modified(large).alias("modified_at"), F.lit(TOO_LARGE).alias("reason")))
    return (files.withColumn("ingestion_timestamp", F.lit(str(ingestion_timestamp)).cast("timestamp"))
            .withColumn("outcome", F.when(F.col("reason").isNull(), "landed").otherwise("rejected")))


def land(files: DataFrame, root: str, name: str, ingestion_timestamp) -> int:
    """Write a run's ``outcomes`` into a generation, in one pass, and put its
    rejects on record.  Returns the number of files landed.  The counts are
    taken behind the exchange, in the stage that writes: a task that is
    repeated counts once."""
    spark, at = files.sparkSession, f"{root.rstrip('/')}/{name}"
    seen = Observation()
    (files.hint("rebalance").observe(seen, F.count_if(F.col("reason").isNull()).alias("landed"), F.count("reason").alias("rejected"))
     .write.mode("append").partitionBy("outcome").parquet(at))
    counts = seen.get
    if not counts.get("landed"):  # readers and streams expect the folder
        spark.createDataFrame([], LANDING_SCHEMA).coalesce(1).write.mode("append").parquet(landed_path(root, name))
    of_run = read_or_empty(spark, f"{at}/outcome=rejected", REJECTED_SCHEMA).where(
        F.col("ingestion_timestamp") == F.lit(str(ingestion_timestamp)).cast("timestamp"))
    record_skipped(of_run, root, ingestion_timestamp, counts.get("rejected"))
    return counts.get("landed") or 0


def unchanged_rejects(files: DataFrame, skipped_files: DataFrame) -> DataFrame:
    """Files whose bytes an earlier run could not decode and that have not
    been changed since, so need not be opened again.  None where the manifest
    does not know when files were changed."""
    known = skipped_files.where((F.col("reason") == NOT_UTF8) & F.col("modified_at").isNotNull()).select(
        F.col("file_path").alias("_path"), F.col("length").alias("_length"), F.col("modified_at").alias("_at")).distinct()
    return files.join(known, (F.col("path") == F.col("_path")) & (F.col("length") == F.col("_length")) & (_modified(files) == F.col("_at")), "left_semi")


def to_land(manifest: DataFrame, landing: DataFrame, skipped_files: DataFrame) -> DataFrame:
    """Metadata ``(path, length[, modificationTime])`` of the files a run has
    to look at: not landed, and not rejected as they are now."""
    names = [c for c in ("path", "source_path", "length", "modificationTime") if c in manifest.columns]
    todo = pending(json_keys(manifest).select(*names), landing)
    if "modificationTime" not in names:
        return todo
    return todo.join(unchanged_rejects(todo, skipped_files).select(F.col("path").alias("_known")), F.col("path") == F.col("_known"), "left_anti")


def bodies(manifest: DataFrame, todo: DataFrame) -> DataFrame:
    """The manifest's rows of the files to be landed.  The source opens no
    file older than the oldest of them; in an hourly run that leaves the new
    files.  The join is against those few names, not against the ledger, so
    it moves no bodies where they are few enough to be broadcast.  A listing
    without bodies (``list_files``) has those files opened by name."""
    if "content" not in manifest.columns:
        return opened(todo)
    if "modificationTime" in manifest.columns:
        oldest = todo.agg(F.min("modificationTime").alias("t")).first()["t"]
        if oldest is None:
            return manifest.where(F.lit(False))
        manifest = manifest.where(F.col("modificationTime") >= F.lit(oldest))
    return manifest.join(todo.select(F.col("path").alias("_todo")), F.col("path") == F.col("_todo"), "left_semi")


def batch_cap(candidates: DataFrame, max_files: int, known_rejects: DataFrame | None = None) -> DataFrame:
    """The first ``max_files`` candidates by path, chosen from metadata alone
    (a top-k).  Files an earlier run rejected come last, so they never keep
    others waiting.  The driver holds the chosen paths, ``max_files`` at
    most; on a file listing only their bodies are read."""
    ranked = candidates.select("path", *[c for c in ("source_path",) if c in candidates.columns])
    if known_rejects is None:
        ranked = ranked.withColumn("again", F.lit(False))
    else:
        known = known_rejects.select(F.col("file_path").alias("path")).distinct().withColumn("again", F.lit(True))
        ranked = ranked.join(known, "path", "left").withColumn("again", F.coalesce("again", F.lit(False)))
    rows = ranked.orderBy("again", "path").limit(max_files).collect()
    if not rows and "content" not in candidates.columns:
        return opened(candidates.limit(0))
    if "source_path" not in candidates.columns or not rows:
        return candidates.where(F.col("path").isin([r["path"] for r in rows])) if rows else candidates.limit(0)
    # the chosen files alone are opened
    if any(r["source_path"].startswith(ARCHIVED) for r in rows):
        return opened(candidates.where(F.col("path").isin([r["path"] for r in rows])))
    spark, key = candidates.sparkSession, {r["source_path"]: r["path"] for r in rows}
    names = F.create_map(*[F.lit(x) for kv in key.items() for x in kv])
    return (spark.read.format("binaryFile").load(list(key))
            .withColumn("source_path", F.col("path")).withColumn("path", names[F.col("path")]))


def incremental_batch(manifest: DataFrame, landing: DataFrame, max_bytes: int | None = None, max_files: int | None = None,
                      ingestion_timestamp=None, known_rejects: DataFrame | None = None) -> DataFrame:
    """One incremental run: json keys -> not yet seen -> size guard -> cap ->
    decode -> stamp."""
    candidates = size_guard(pending(json_keys(manifest), landing), max_bytes)
    if max_files is not None:
        candidates = batch_cap(candidates, max_files, known_rejects)
    return stamp(decode(candidates), ingestion_timestamp)


def run_timestamp(spark: SparkSession) -> str:
    """The load time of one run, fixed up front (session time zone)."""
    return spark.range(1).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t")).first()["t"]


def ingest_incremental(spark: SparkSession, manifest: DataFrame, landing_path: str, max_bytes: int | None = None,
                       max_files: int | None = None, ingestion_timestamp=None) -> int:
    """Append one incremental batch to the landing table; returns files added.

    The batch is read against the landing snapshot as of the start of the
    run and appended in one write (single writer assumed, as in the
    reference's hourly job).  Files left out for their size or bytes are
    recorded.  A later run tries them again: those too large whenever its
    limit allows, undecodable ones when they have been changed (always, if
    the manifest does not tell when files were changed).
    """
    ts = str(ingestion_timestamp) if ingestion_timestamp is not None else run_timestamp(spark)
    on_record = read_skipped(spark, landing_path)
    todo = to_land(manifest, read_landing(spark, landing_path), on_record)
    large = None if max_bytes is None else todo.where(F.col("length") > F.lit(max_bytes))
    fit = size_guard(todo, max_bytes)
    if max_files is None:
        chosen = bodies(manifest, fit)
    else:
        chosen = batch_cap(fit if "content" not in manifest.columns else bodies(manifest, fit), max_files, on_record)
    return land(outcomes(chosen, ts, large), landing_path, generation(spark, landing_path), ts)


def full_refresh_rows(manifest: DataFrame, max_bytes: int | None = None, ingestion_timestamp=None) -> DataFrame:
    """Every json file within the size limit (no ledger, no cap)."""
    return stamp(decode(size_guard(json_keys(manifest), max_bytes)), ingestion_timestamp)


def ingest_full_refresh(spark: SparkSession, manifest: DataFrame, landing_path: str, max_bytes: int | None = None,
                        ingestion_timestamp=None) -> bool:
    """Replace the landing table with all current files, if there is at
    least one; otherwise leave it untouched.  Returns whether it replaced."""
    root = landing_path.rstrip("/")
    ts = str(ingestion_timestamp) if ingestion_timestamp is not None else run_timestamp(spark)
    new = f"g-{uuid.uuid4().hex[:12]}"
    files = json_keys(manifest)
    large = None if max_bytes is None else files.where(F.col("length") > F.lit(max_bytes))
    fit = size_guard(files, max_bytes)
    if "content" not in files.columns:
        fit = opened(fit)
    if not land(outcomes(fit, ts, large), root, new, ts):  # its rejects are on record all the same
        return False
    spark.range(1).select(F.lit(new).alias("generation"), F.current_timestamp().alias("at")) \
        .write.mode("append").parquet(f"{root}/_generations")
    return True
