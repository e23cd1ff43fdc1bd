"""Session builder and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "textmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution; ``conf`` uses ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in local mode with none set."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="textmill-checkpoint-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir()


def run_folder(spark: SparkSession) -> str:
    """The folder of everything this application writes between its jobs."""
    return f"{checkpoint_root(spark)}/textmill-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the run folder for a table written between two jobs."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table that no later step reads."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Remove the run folder at a job's end; tables read from it are gone then."""
    discard(spark, run_folder(spark))


#: Spark removes the shuffle files of a statement that ran under this setting at the statement's end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _held, _before = threading.Lock(), Counter(), {}


@contextmanager
def _without_shuffle_files(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files; the session's setting comes back when the last thread leaves."""
    with _lock:
        if not _held[spark]:
            _before[spark] = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        _held[spark] += 1
    try:
        yield
    finally:
        with _lock:
            _held[spark] -= 1
            if not _held[spark]:
                del _held[spark]
                before = _before.pop(spark)
                spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and the
    reader knows the table's size, so joins on it may broadcast only when it is small."""
    path = scratch_path(df.sparkSession, name)
    with _without_shuffle_files(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
