"""Shared helpers: table access, written intermediates, text batches, word hashes."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = "1000"             # rows of an Arrow batch: whole texts, so fewer than Spark's 10,000


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did (one machine or a shared
    installation; elsewhere ship it with ``--py-files``), and send them texts in small batches
    where the session sets no size of its own."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, BATCH_ROWS)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where the session names none and runs in one process (tests) is a
    private folder set; on a cluster that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="riskmart-llm-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_root(spark)}/llm/{tag}-{uuid.uuid4().hex}"


def release_shuffles(spark: SparkSession) -> None:
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stash(df: DataFrame, tag: str, release: bool = True) -> DataFrame:
    """Write ``df`` to the shared folder and return it reread: lineage ends here.

    A lost executor costs at most the tasks that read the files again.  The shuffle
    files behind it are of no more use; Spark drops them once the driver has collected
    their handles, so that is done now (``release``).
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, tag)
    if release:
        release_shuffles(spark)
    df.write.option("compression", "zstd").parquet(path)
    if release:
        release_shuffles(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out.stash_path = path
    return out


def discard(*written: DataFrame) -> None:
    """Delete stashed tables that nothing reads any more: later steps read later tables."""
    for df in written:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.stash_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def whole_text(name: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def repeats_numbered(df: DataFrame, count: str = "copies") -> DataFrame:
    """One row for each repeat counted in ``count``, numbered from 0 in ``copy_no``."""
    return (df.withColumn("copy_no", F.explode(F.sequence(F.lit(0), (F.col(count) - 1).cast("int"))))
              .drop(count))


def as_rows(docs: DataFrame, **own: Column) -> DataFrame:
    """``docs`` with each row as one struct ``row``, beside columns worked out from it: whatever names
    ``docs`` has, they clash with none of ours."""
    return docs.select(F.struct(*(F.col(_quoted(c)) for c in docs.columns)).alias("row"),
                       *(c.alias(name) for name, c in own.items()))


def rows_back(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` out of the structs of :func:`as_rows`."""
    return rows.select(*(F.col("row")[c].alias(c) for c in docs.columns))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sortable(column: Column, kind: T.DataType) -> Column:
    """A column to order by; maps and variants, which have no order, by their JSON text."""
    def ordered(t: T.DataType) -> bool:
        if isinstance(t, T.ArrayType):
            return ordered(t.elementType)
        if isinstance(t, T.StructType):
            return all(ordered(f.dataType) for f in t)
        return not isinstance(t, (T.MapType, T.VariantType))
    return column if ordered(kind) else F.to_json(F.struct(column.alias("c")))


def first_of_repeats(docs: DataFrame, key: Column, stays: DataFrame, every: Column | None = None) -> DataFrame:
    """The rows of ``docs`` whose doc_id and ``key`` are in ``stays`` (_id, _key), with all their columns.

    Of rows that repeat both, the first by the other columns stays; all do where ``every`` holds.
    """
    rows = as_rows(docs, row_id=F.col("doc_id").cast("long"), row_key=key,
                   row_every=F.lit(False) if every is None else every)
    found = rows.join(stays.select("_id", "_key"), F.col("row_id").eqNullSafe(F.col("_id")) & (
        F.col("row_key") == F.col("_key")))
    others = [_sortable(F.col("row")[f.name], f.dataType) for f in docs.schema if f.name not in ("doc_id", "text")]
    order = Window.partitionBy("_id", "_key").orderBy(*others, "_id")
    return rows_back(found.withColumn("_place", F.row_number().over(order)).where("_place = 1 or row_every"), docs)


# -- memory of Python workers ----------------------------------------------------------

def _trim() -> None:
    """Give what this process no longer uses back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass                                            # a C library that has no such call


def tidied(run):
    """``run`` for mapInArrow; at a task's end its memory is returned, since workers live on for later stages."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _trim()
    return task


# -- text columns inside Arrow tasks -------------------------------------------------

def raw_texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text of an Arrow string column, without decoding."""
    for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield x.as_py() or b""


def slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """Parts of at most ``rows`` rows, so that numpy scratch stays small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


class Remembered(dict):
    """A memory of two generations: past ``limit`` entries the older one goes, but what is used stays."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.older = limit, {}

    def __missing__(self, key):
        self[key] = value = self.older[key]
        return value

    def make_room(self) -> None:
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()

    def unknown(self, texts: list[list[bytes]]) -> list[bytes]:
        """The distinct words of ``texts`` that are not remembered."""
        older = self.older
        return [w for w in {w for ws in texts for w in ws if w not in self} if w not in older]


class WordHashes(dict):
    """Bytes of a word -> unsigned 64-bit hash, remembered up to ``limit`` words."""

    def __init__(self, limit: int = 400_000, seed: bytes = b"word"):
        super().__init__()
        self.limit, self.seed = limit, seed

    def value(self, word: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(word, digest_size=8, key=self.seed).digest(), "little")

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        found = self.value(word)
        self[word] = found
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD1B54A32D192ED03)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words; a shorter text is one run of all its words."""
    if not len(words):
        return words
    span = min(n, len(words))
    out = np.full(len(words) - span + 1, np.uint64(span), np.uint64)
    for k in range(span):
        out = mix(out * np.uint64(0x2545F4914F6CDD1D) + words[k: len(words) - span + 1 + k])
    return out


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(shingle_hashes(words, n))


# -- connected components ---------------------------------------------------------------

def components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """Smallest reachable id for every id that occurs in ``edges`` (columns a, b).

    Alternates large-star and small-star steps until the edges are stars around the
    smallest ids, which one grouping tells; edges that are stars already take no step.
    Every step is one shuffle with map-side minima, and every round is written to the
    shared folder.  A node of very many links is a group with a plain ``min``, never a
    collected list.
    Returns (id, component_id).
    """
    def both(e: DataFrame) -> DataFrame:
        return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(e: DataFrame, larger: bool) -> DataFrame:
        # every node's smallest neighbour (or itself) takes the node's neighbours
        links = both(e) if larger else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = links.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        low = stash(low, f"{tag}-low", release=False)
        joined = links.join(low, "a")
        if larger:
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                low.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def is_stars(e: DataFrame) -> bool:
        # no id has two smaller neighbours, or a smaller and a larger one
        ends = e.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            e.select(F.col("b").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        ends = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return not ends.where("up > 1 or up + down > 1").agg(F.count("*")).first()[0]

    now = stash(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                tag)
    while not is_stars(now):
        now = stash(star(star(now, True), False), tag, release=False)
    return now.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component_id")).union(
        now.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct())
