"""The case-note table: hash buckets of the key, of which an upsert rewrites only those it touches.

A manifest names the folder of every bucket.  An upsert reads the buckets its keys fall
into, writes their new content into folders of its own and publishes a manifest that names
these and, for all other buckets, the folders they had.  What is written thus follows the
batch, not the table.  Of two upserts that started from one manifest the second to publish
starts again on the new one; readers keep the manifest they opened.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.operators import casenotes as cn
from riskmart.schema import CASE_NOTE_TYPES, ddl
from riskmart.session import join_path
from riskmart.sources.manifest import Manifests

BUCKET = "bucket"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class NoteTable:
    """A case-note table under ``root``; ``buckets`` counts for a table that is not there yet."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 256, attempts: int = 10):
        self.spark, self.root = spark, root.rstrip("/")
        self.buckets, self.attempts = buckets, attempts
        self.manifests = Manifests(spark, self.root)

    def _state(self) -> dict:
        found = self.manifests.latest()
        return found[1] if found else {"buckets": self.buckets, "folders": {}}

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return cn.empty_notes(self.spark)
        return self.spark.read.schema(ddl(CASE_NOTE_TYPES)).parquet(*(join_path(self.root, f) for f in folders))

    def _write(self, notes: DataFrame, buckets: int) -> dict[str, str]:
        """Write ``notes`` into new folders, one for each bucket they fall into."""
        data = f"data-{uuid.uuid4().hex}"
        (notes.withColumn(BUCKET, bucket_of("transaction_id", buckets)).repartition(BUCKET)
         .write.partitionBy(BUCKET).option("compression", "zstd").parquet(join_path(self.root, data)))
        found = self.manifests.folders(join_path(self.root, data))
        return {f.split("=")[1]: f"{data}/{f}" for f in found if f.startswith(f"{BUCKET}=")}

    def version(self) -> int | None:
        found = self.manifests.latest()
        return found[0] if found else None

    def latest(self) -> DataFrame:
        """The newest notes, pinned to their folders."""
        return self._read(sorted(self._state()["folders"].values()))

    def upsert(self, incoming: DataFrame) -> list[int]:
        """Insert or replace by key (``created_at`` of a known key stays); the buckets that were rewritten."""
        for _ in range(self.attempts):
            number, state = self.manifests.next_number(), self._state()
            n = state["buckets"]
            # at most one row for each bucket
            touched = sorted(r[0] for r in incoming.select(bucket_of("transaction_id", n)).distinct().collect())
            if not touched:
                return []
            old = self._read([f for b, f in state["folders"].items() if int(b) in touched])
            written = self._write(cn.upsert_case_notes(old, incoming), n)
            if self.manifests.publish(number, {"buckets": n, "folders": {**state["folders"], **written}}):
                return touched
            self._discard(written)
        raise RuntimeError(f"{self.attempts} upserts of {self.root} were each overtaken by another writer")

    def rebucket(self, buckets: int) -> None:
        """Rewrite the whole table in another number of buckets, as it grows."""
        number = self.manifests.next_number()
        written = self._write(self.latest(), buckets)
        if not self.manifests.publish(number, {"buckets": buckets, "folders": written}):
            self._discard(written)
            raise RuntimeError(f"{self.root} was changed meanwhile")

    def _discard(self, written: dict[str, str]) -> None:
        for folder in {f.split("/")[0] for f in written.values()}:
            self.manifests.delete(join_path(self.root, folder))

    def prune(self, keep: int = 2) -> list[str]:
        """Delete folders of buckets that none of the newest ``keep`` manifests names; no upsert may be under way."""
        whole = [c for n in self.manifests.numbers() if (c := self.manifests.content(n)) is not None]
        named = {f for c in whole[-keep:] for f in c["folders"].values()} if keep else set()
        gone = [f"{d}/{b}" for d in self.manifests.folders(self.root) if d.startswith("data-")
                for b in self.manifests.folders(join_path(self.root, d)) if f"{d}/{b}" not in named]
        for folder in gone:
            self.manifests.delete(join_path(self.root, folder))
        return gone
