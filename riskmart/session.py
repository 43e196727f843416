"""Session helpers: a configured SparkSession and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job here relies on.  Runtime SQL settings only; cluster sizing
# (executors, memory) belongs to whoever launches the application.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
JOB_SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Python's json keeps the last of duplicate keys; make the variant parser agree.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Layers are partitioned by split (two values): keep one writer per value open
    # instead of sorting every task's (wide) rows by the partition column first.
    WRITERS: "4",
}
_LOCK = threading.Lock()
_OPEN: dict[int, int] = {}      # session -> blocks of open_writers that are under way in it


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "riskmart", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the jobs expect."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in JOB_SQL_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def open_writers(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes in this block keep a writer for each value open, in any session.

    A session of the caller's own settings has none of ``JOB_SQL_CONF``; there Spark would
    sort all rows of a task by the partition column, and a task over a well compressed file
    has many times the file's size in rows.  A number that the caller has set stays.
    """
    with _LOCK:
        if id(spark) in _OPEN:
            _OPEN[id(spark)] += 1
        elif int(spark.conf.get(WRITERS, "0")) == 0:
            spark.conf.set(WRITERS, JOB_SQL_CONF[WRITERS])
            _OPEN[id(spark)] = 1
    try:
        yield
    finally:
        with _LOCK:
            if id(spark) in _OPEN:
                _OPEN[id(spark)] -= 1
                if not _OPEN[id(spark)]:
                    del _OPEN[id(spark)]
                    spark.conf.set(WRITERS, "0")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for written layers and checkpoints.

    Taken from ``spark.checkpoint.dir`` (the cluster's shared storage).  Only
    when the session has none and runs in one process (tests) a private folder under
    the system temp dir is created and registered as the checkpoint dir; on a cluster,
    whose executors could not see it, that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:        # a remote (Connect) session has no local SparkContext
        sc = None
    if not path and sc is not None:
        path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if sc is not None and sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="riskmart-")
        if sc is not None:
            sc.setCheckpointDir(path)
            path = sc.getCheckpointDir() or path
    return path.rstrip("/")


def join_path(root: str, *parts: str) -> str:
    if "://" in root:
        return "/".join([root.rstrip("/"), *parts])
    return os.path.join(root, *parts)
