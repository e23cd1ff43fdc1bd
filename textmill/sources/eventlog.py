"""Spark event logs and console logs of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.session import cut

# The fields of the event log that the metrics need.
EVENT_SCHEMA = """
  `Event` string,
  `App ID` string,
  `Timestamp` bigint,
  `Executor ID` string,
  `Task Info` struct<`Executor ID`: string>,
  `Task Metrics` struct<
    `Executor Run Time`: bigint, `JVM GC Time`: bigint,
    `Memory Bytes Spilled`: bigint, `Disk Bytes Spilled`: bigint,
    `Shuffle Read Metrics`: struct<`Fetch Wait Time`: bigint>,
    `Shuffle Write Metrics`: struct<`Shuffle Write Time`: bigint>>,
  `Executor Metrics Updated` array<struct<`Executor Metrics`: struct<`JVMHeapMemory`: bigint>>>,
  `Executor Metrics` struct<`JVMHeapMemory`: bigint>
"""
APP_PATTERN = r"((?:application|app|local)[-_][0-9]{13,14}(?:[-_][0-9]+)?)"
YARN_APP_PATTERN = r"(application_[0-9]{13}_[0-9]+)"
MIB = 1024 * 1024
EPSILON = 1e-9
#: Files that a scan's filter names at most.
NAMES = 10_000
STEPS = ["1", "2", "3", "4", "5a", "5b", "6a", "6b"]


def app_of(path: Column) -> Column:
    """The last application id in a log's path; where there is none of a known form, the file's name up to its first dot."""
    name = F.regexp_extract(path, r"([^/.]+)[^/]*$", 1)
    return F.coalesce(F.nullif(F.regexp_extract(path, ".*" + APP_PATTERN, 1), F.lit("")), name)


def _below(spark: SparkSession, root: str, file: Column) -> Column:
    """A file's path below the folder that was asked for, whose own name says nothing about a log.

    A root that is a pattern, or the log itself, leaves the path below its parent folder.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    plain = not any(c in root for c in "*?[{") and system.exists(path) and system.getFileStatus(path).isDirectory()
    depth = len(system.makeQualified(path).toUri().getPath().rstrip("/").split("/")) - (0 if plain else 1)
    # By depth: a scheme's slashes and escapes in names differ between listings, the number of folders does not.
    parts = F.split(F.regexp_replace(file, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), "/")
    return F.array_join(F.slice(parts, F.lit(depth + 1), F.size(parts)), "/")


def list_logs(spark: SparkSession, path: str) -> DataFrame:
    """``(app, listing, file, modified)`` of every log file, without reading any content.

    The application is taken from the path below ``path``. Parts of one rolled log
    lie in a folder named after the application and share its listing.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("modificationTime").alias("modified"))
    )
    below = _below(spark, path, F.col("file"))
    in_folder = F.regexp_extract(below, APP_PATTERN + r"/[^/]+$", 1) != ""
    listing = F.when(in_folder, F.regexp_replace("file", r"/[^/]+$", "")).otherwise(F.col("file"))
    return files.select(app_of(below).alias("app"), listing.alias("listing"), "file", "modified")


def latest_logs(listing: DataFrame) -> DataFrame:
    """The files of each application's newest listing entry."""
    newest = listing.groupBy("app").agg(F.max_by("listing", F.struct("modified", "listing")).alias("listing"))
    return listing.join(newest, ["app", "listing"], "left_semi").select("app", "file")


def read_event_logs(spark: SparkSession, path: str, latest_only: bool = True, names: int = NAMES) -> DataFrame:
    """Events with their ``app``; malformed lines are skipped.

    With ``latest_only`` an application listed several times counts with its
    newest log: the file listing, made without reading content, is joined on the
    file's path. Up to ``names`` wanted files are named in the scan's filter as well, so
    that no other file is opened; with more, all are read and the join alone selects.
    """
    lines = (
        spark.read.option("recursiveFileLookup", "true").option("mode", "DROPMALFORMED").schema(EVENT_SCHEMA).json(path)
    )
    events = lines.select("*", F.col("_metadata.file_path").alias("file"))
    if latest_only:
        newest = cut(latest_logs(list_logs(spark, path)).select("file"), "newest")
        wanted = [r["file"] for r in newest.limit(names + 1).collect()]
        if len(wanted) <= names:
            events = events.where(F.col("_metadata.file_path").isin(wanted))
        events = events.join(newest, "file", "left_semi")
    return events.withColumn("app", app_of(_below(spark, path, F.col("file")))).drop("file")


def _of(event: str, value: Column) -> Column:
    return F.when(F.col("Event") == event, value)


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(_of("SparkListenerTaskEnd", value)), F.lit(0))


def eventlog_metrics(events: DataFrame, apps: DataFrame | None = None) -> DataFrame:
    """One row of run metrics per application, in milliseconds and MiB.

    ``apps(app)`` names the applications wanted; those without a log get zeros.
    Executors' peaks are combined per executor first, then over executors, and
    both kinds of peak event are read.
    """
    task = F.col("Task Metrics")
    updates = F.array_max(F.transform("Executor Metrics Updated", lambda u: u["Executor Metrics"]["JVMHeapMemory"]))
    heap = F.when(F.col("Event") == "SparkListenerExecutorMetricsUpdate", updates).when(
        F.col("Event") == "SparkListenerStageExecutorMetrics", F.col("Executor Metrics.JVMHeapMemory")
    )
    # Per executor first: many small groups, so even one application's events spread.
    executor = F.coalesce(F.col("Executor ID"), F.col("Task Info.Executor ID")).alias("executor")
    per_executor = events.groupBy("app", executor).agg(
        F.max(_of("SparkListenerApplicationStart", F.col("Timestamp"))).alias("started"),
        F.max(_of("SparkListenerApplicationEnd", F.col("Timestamp"))).alias("ended"),
        _total(task["Executor Run Time"]).alias("run"),
        _total(task["JVM GC Time"]).alias("gc"),
        _total(task["Memory Bytes Spilled"]).alias("mem_spill"),
        _total(task["Disk Bytes Spilled"]).alias("disk_spill"),
        _total(task["Shuffle Read Metrics"]["Fetch Wait Time"]).alias("read"),
        _total(task["Shuffle Write Metrics"]["Shuffle Write Time"]).alias("write_ns"),
        F.max(heap).alias("heap"),
    )
    sums = per_executor.groupBy("app").agg(
        F.max("started").alias("started"),
        F.max("ended").alias("ended"),
        *[F.sum(c).alias(c) for c in ["run", "gc", "mem_spill", "disk_spill", "read", "write_ns"]],
        F.max("heap").alias("heap"),
    )
    total = F.coalesce(F.col("ended") - F.col("started"), F.lit(0))
    write = F.col("write_ns") / 1_000_000
    communication = F.col("read") + write
    compute = F.col("run") - communication - F.col("gc")
    run = F.col("run") + F.lit(EPSILON)
    metrics = sums.select(
        "app",
        total.alias("total_time_ms"),
        F.col("run").alias("executor_run_time_ms"),
        (F.col("run") / (total + F.lit(EPSILON))).alias("parallelism_factor"),
        F.col("gc").alias("gc_time_ms"),
        (F.col("gc") / run).alias("gc_ratio"),
        F.col("read").alias("shuffle_read_ms"),
        write.alias("shuffle_write_ms"),
        communication.alias("communication_ms"),
        (communication / run).alias("communication_ratio"),
        compute.alias("compute_ms"),
        (compute / run).alias("compute_ratio"),
        (F.col("mem_spill") / MIB).alias("memory_spill_mb"),
        (F.col("disk_spill") / MIB).alias("disk_spill_mb"),
        (F.coalesce("heap", F.lit(0)) / MIB).alias("peak_heap_mb"),
    )
    if apps is None:
        return metrics
    return apps.select("app").distinct().join(metrics, "app", "left").na.fill(0)


def runlog_scrape(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """One row per console log: last application id, total time and step times; 0 where missing."""
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.struct(
                F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq")
            ).alias("at"),
            "value",
        )
    )
    last_app = F.element_at(F.regexp_extract_all("value", F.lit(YARN_APP_PATTERN), F.lit(1)), -1)

    def seconds(pattern: str) -> Column:
        return F.regexp_extract("value", pattern, 1).try_cast("double")

    found = lines.select(
        "file",
        "at",
        F.when(F.col("value").rlike(YARN_APP_PATTERN), last_app).alias("app"),
        seconds(r"(?i)Total execution time: *([0-9.]+)").alias("total"),
        *[seconds(rf"Step {s} completed.* ([0-9.]+) \S+$").alias(f"S{s}") for s in STEPS],
    )

    def last(column: str) -> Column:
        present = F.col(column).isNotNull()
        return F.max_by(column, F.when(present, F.col("at")))

    return found.groupBy("file").agg(
        last("app").alias("AppID"),
        *[F.coalesce(last(f"S{s}"), F.lit(0.0)).alias(f"S{s}") for s in STEPS],
        F.coalesce(last("total"), F.lit(0.0)).alias("TotalTime"),
    )
