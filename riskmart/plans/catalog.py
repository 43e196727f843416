"""Query catalog: every registered query as ``fn(spark, sf_dir) -> DataFrame``.

Queries read the pipeline's written layers.  The layers of one input folder
are built once per code version, shared folder and state of the input's files, then
reused by every query.

A build is published as one set once its last layer is written, so a build that was cut
off is never read, and of two applications that build at the same moment one publishes
and both read that set (a lock guards threads of one driver).
"""

from __future__ import annotations

import hashlib
import os
import threading
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from riskmart.plans.pipeline import Layers, build_layers
from riskmart.session import join_path, shared_dir
from riskmart.sources.events import events_to_identity, staged_from_events
from riskmart.sources.layer_sets import LayerSets

_LOCK = threading.Lock()
_BUILT: dict[tuple[str, str, str], Layers] = {}


def _code_version() -> str:
    h = hashlib.sha1()
    root = Path(__file__).resolve().parent.parent
    for p in sorted(root.rglob("*.py")):
        h.update(p.relative_to(root).as_posix().encode())
        h.update(p.read_bytes())
    return h.hexdigest()[:12]


CODE_VERSION = _code_version()


def _input_state(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and times of the input's files: a changed input gets layers of its own."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    return ",".join(sorted(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}"
                           for f in fs.listStatus(path)))


def layers_for(spark: SparkSession, sf_dir: str) -> Layers:
    """Written layers for the driver tables in ``sf_dir`` (built on first use).

    The files are shared by every session that names the same shared folder;
    the wrapper (which holds frames of one session) is reused only by that
    session, so a new session after ``stop()`` reopens the files instead.
    """
    sf_dir = sf_dir.rstrip("/")
    base = shared_dir(spark)
    state = _input_state(spark, sf_dir)
    key = (base, sf_dir, state)
    with _LOCK:
        layers = _BUILT.get(key)
        if layers is not None and layers.store.spark is spark:
            return layers
        place = sf_dir if "://" in sf_dir else os.path.abspath(sf_dir)
        slug = hashlib.sha1(f"{place} {state}".encode()).hexdigest()[:10]
        root = join_path(base, "riskmart-layers", f"{slug}-{CODE_VERSION}")
        layers = Layers(LayerSets(spark, root).current_or_build(lambda store: build_layers(
            store, staged_from_events(spark, sf_dir)[0], identity_from_transactions=events_to_identity)))
        _BUILT[key] = layers
        return layers


QueryFn = Callable[[SparkSession, str], DataFrame]
