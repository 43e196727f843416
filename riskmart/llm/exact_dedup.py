"""Exact deduplication by composable polynomial fingerprints.

A text's fingerprint is its polynomial value at four fixed points modulo the prime
2^31 - 1 (low byte first), with its length.  The value of a whole is the sum of the
values of its chunks, each shifted by the power of its offset, so chunks of a huge
text are hashed in different tasks and added up by an ordinary ``sum``.  Rows of
equal fingerprint are then compared chunk by chunk, as bytes, against the first
text of their class; a group of very many bytes is dealt over buckets whose first
texts are compared in a second round.

Defined cases: a null text counts as empty; a null id takes part and loses to any
id; rows that repeat id and text are one document each, of which one stays; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import first_of_repeats, raw_texts, repeats_numbered, stash, tidied, whole_text

PRIME = (1 << 31) - 1
POINTS = (1_103_515_245, 1_566_083_941, 742_938_285, 1_812_433_253)
BLOCK = 8192            # (255 + 1) * 2^31 * 8192 = 2^52: sums of a block are exact in a double
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 64 << 20
KEY = ["f1", "f2", "n_bytes"]


def shift(point: int, count: int) -> int:
    return pow(point, count, PRIME)


@lru_cache(1)
def _powers() -> np.ndarray:
    out = np.ones((BLOCK, len(POINTS)), np.int64)
    for i in range(1, BLOCK):
        out[i] = out[i - 1] * POINTS % PRIME
    return out.astype(np.float64)


def chunk_value(data: bytes) -> list[int]:
    """The polynomial of ``data`` at each point: sum of (byte + 1) * point^position."""
    powers = _powers()
    digits = np.frombuffer(data, np.uint8).astype(np.float64) + 1
    full = len(digits) // BLOCK
    total = (digits[full * BLOCK:] @ powers[: len(digits) - full * BLOCK]).astype(np.int64) % PRIME
    out = [int(v) * shift(q, full * BLOCK) % PRIME for v, q in zip(total, POINTS)]
    if full:
        blocks = (digits[: full * BLOCK].reshape(full, BLOCK) @ powers).astype(np.int64) % PRIME
        for k, q in enumerate(POINTS):
            step, at = shift(q, BLOCK), 1
            for v in blocks[:, k].tolist():
                out[k] = (out[k] + v * at) % PRIME
                at = at * step % PRIME
    return out


def joined_value(left: list[int], left_bytes: int, right: list[int]) -> list[int]:
    """The value of two texts one after the other."""
    return [(a + b * shift(q, left_bytes)) % PRIME for a, b, q in zip(left, right, POINTS)]


def _packed(values: list[list[int]]) -> tuple[pa.Array, pa.Array]:
    v = np.array(values, np.int64).reshape(-1, 4)
    return pa.array((v[:, 0] << 31) | v[:, 1]), pa.array((v[:, 2] << 31) | v[:, 3])


def _hash_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values, sizes, digests = [], [], []
        for data in raw_texts(batch.column("text")):
            values.append(chunk_value(data))
            sizes.append(len(data))
            digests.append(hashlib.sha256(data).hexdigest())
        f1, f2 = _packed(values)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), f1, f2, pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
            ["doc_id", "f1", "f2", "n_bytes", "text_sha256"])


def _cutter(chunk_bytes: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = (TaskContext.get().partitionId() << 33) - 1
        for batch in batches:
            for doc, data in zip(batch.column("doc_id"), raw_texts(batch.column("text"))):
                row += 1
                digest = hashlib.sha256(data).hexdigest()
                for at in range(0, len(data), chunk_bytes):
                    yield pa.RecordBatch.from_pydict(
                        {"row": [row], "doc_id": [doc.as_py()], "text_sha256": [digest], "n_bytes": [len(data)],
                         "at": [at], "chunk": [data[at: at + chunk_bytes]]},
                        pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("text_sha256", pa.string()),
                                   ("n_bytes", pa.int64()), ("at", pa.int64()), ("chunk", pa.binary())]))
    return cut


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shifted = [joined_value([0] * 4, at, chunk_value(data))
                   for at, data in zip(batch.column("at").to_pylist(), raw_texts(batch.column("chunk")))]
        v = np.array(shifted, np.int64).reshape(-1, 4)
        kept = ["row", "doc_id", "text_sha256", "n_bytes"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(v[:, k]) for k in range(4))],
                                         [*kept, "v0", "v1", "v2", "v3"])


def fingerprints(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, f1, f2, n_bytes, text_sha256) of every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    whole = docs.where(F.octet_length("text") <= chunk_bytes).mapInArrow(
        tidied(_hash_whole), "doc_id long, f1 long, f2 long, n_bytes long, text_sha256 string")
    parts = (docs.where(F.octet_length("text") > chunk_bytes)
             .mapInArrow(_cutter(chunk_bytes),
                         "row long, doc_id long, text_sha256 string, n_bytes long, at long, chunk binary")
             .repartition("row", "at")
             .mapInArrow(tidied(_hash_chunks), "row long, doc_id long, text_sha256 string, n_bytes long, "
                                       "v0 long, v1 long, v2 long, v3 long"))
    value = [(F.sum(f"v{k}") % PRIME).alias(f"v{k}") for k in range(4)]
    parts = parts.groupBy("row", "doc_id", "text_sha256", "n_bytes").agg(*value)
    return whole.unionByName(parts.select(
        "doc_id", F.shiftleft("v0", 31).bitwiseOR(F.col("v1")).alias("f1"),
        F.shiftleft("v2", 31).bitwiseOR(F.col("v3")).alias("f2"), "n_bytes", "text_sha256"))


def same_bytes(a: bytes, b: bytes, step: int = 1 << 20) -> bool:
    """Chunkwise comparison: stops at the first chunk that differs."""
    left, right = memoryview(a), memoryview(b)
    return len(a) == len(b) and all(left[i: i + step] == right[i: i + step] for i in range(0, len(a), step))


_CLASSED = ("doc_id long, text_sha256 string, f1 long, f2 long, n_bytes long, bucket int, class int, "
            "head binary")


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the different texts of each (f1, f2, n_bytes, bucket); rows come sorted by that key.

    Held in memory: one text of each class of the current key (one, unless fingerprints collide).
    """
    now, heads = None, []
    for batch in batches:
        numbers, first = [], []
        keys = zip(*(batch.column(c).to_pylist() for c in (*KEY, "bucket", "buckets")))
        for (*key, buckets), data in zip(keys, raw_texts(batch.column("text"))):
            if key != now:
                now, heads = key, []
            k = next((k for k, h in enumerate(heads) if same_bytes(h, data)), len(heads))
            first.append(data if k == len(heads) and buckets > 1 else None)
            if k == len(heads):
                heads.append(data)
            numbers.append(k)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "text_sha256", *KEY, "bucket")),
             pa.array(numbers, pa.int32()), pa.array(first, pa.binary())],
            ["doc_id", "text_sha256", *KEY, "bucket", "class", "head"])


def decide(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES,
           weaken: int | None = None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row of the largest doc_id stays.  ``weaken`` reduces
    fingerprints to so many values; only the byte comparison then tells texts apart.
    """
    prints = fingerprints(docs, chunk_bytes)
    if weaken:
        prints = prints.withColumns({"f1": F.pmod("f1", F.lit(weaken)), "f2": F.lit(0).cast("long")})
    prints = stash(prints, "prints")
    groups = stash(prints.groupBy(*KEY).agg(F.count("*").alias("rows"))
                   .where("rows > 1")
                   .withColumn("buckets", F.ceil(F.col("rows") * F.col("n_bytes") / bucket_bytes).cast("int"))
                   .withColumn("buckets", F.greatest("buckets", F.lit(1))), "print-groups")
    joined = prints.join(groups, KEY, "left")
    alone = joined.where("rows is null").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")

    # the digest tells rows of one id apart when they are brought together with their texts
    shared = joined.where("rows is not null").select(
        F.col("doc_id").alias("id"), "text_sha256", *KEY, "buckets").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    texts = (texts.join(shared, F.col("doc_id").eqNullSafe(F.col("id"))
                        & (F.octet_length("text").cast("long") == F.col("n_bytes")))
             .where(F.sha2("text", 256) == F.col("text_sha256"))
             .withColumn("bucket", F.pmod(F.xxhash64("id", F.lit(7)), F.col("buckets")).cast("int"))
             .select("doc_id", "text_sha256", *KEY, "bucket", "buckets", "text"))
    key = [*KEY, "bucket"]
    found = stash(texts.repartition(*key).sortWithinPartitions(*key).mapInArrow(tidied(_classes), _CLASSED), "classes")

    # first texts of the buckets of a large group, compared among themselves
    firsts = (found.where("head is not null")
              .select(F.col("bucket").cast("long").alias("doc_id"), F.col("class").cast("string").alias("text_sha256"),
                      *KEY, F.lit(0).alias("bucket"), F.lit(1).alias("buckets"), F.col("head").alias("text")))
    merged = (firsts.repartition(*KEY).sortWithinPartitions(*KEY).mapInArrow(tidied(_classes), _CLASSED)
              .select(*KEY, F.col("doc_id").cast("int").alias("bucket"),
                      F.col("text_sha256").cast("int").alias("class"), F.col("class").alias("merged")))
    found = (found.drop("head").join(stash(merged, "class-heads"), [*KEY, "bucket", "class"], "left")
             .withColumn("class", F.coalesce("merged", "class")))
    counted = found.groupBy(*KEY, "class", "doc_id", "text_sha256").agg(F.count("*").alias("copies"))
    counted = stash(counted, "class-rows")
    kept = stash(counted.groupBy(*KEY, "class").agg(F.max("doc_id").alias("keep_id"),
                                                    F.sum("copies").alias("group_size")), "class-keeps")
    copies = repeats_numbered(counted.join(kept, [*KEY, "class"]))
    return alone.unionByName(copies.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy_no") == 0)).alias("kept"), "text_sha256"))


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that repeat id and text, the first
    by its other columns."""
    stays = stash(decide(docs, **options).where("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_key")), "stays")
    return first_of_repeats(docs, F.sha2(whole_text(), 256), stays)
