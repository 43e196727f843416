"""Layer sets: all layers of one build are published together, or not at all.

A build writes its layers into a folder of its own, ``<root>/builds/<id>``.  When the last
one is written, one manifest names that folder; until then readers see the set before it.
A build that is killed half-way is never seen.  Of two builds that started from the same
manifest the first to publish wins, and the other raises ``LostBuild``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from riskmart.session import join_path
from riskmart.sources.manifest import Manifests
from riskmart.sources.tables import LayerStore


class LostBuild(RuntimeError):
    """Another writer published a set since this build began."""


class LayerSets:
    """The published layer sets under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.manifests = Manifests(spark, self.root)

    def _store(self, build: str) -> LayerStore:
        return LayerStore(self.spark, join_path(self.root, "builds", build))

    def current(self) -> LayerStore | None:
        """The newest published set, pinned: later publications do not change what it reads."""
        found = self.manifests.latest()
        return self._store(found[1]["build"]) if found else None

    def build(self, write: Callable[[LayerStore], object], info: dict | None = None) -> LayerStore:
        """Let ``write`` fill a new set, then publish it."""
        number, build = self.manifests.next_number(), uuid.uuid4().hex
        store = self._store(build)
        write(store)
        if not self.manifests.publish(number, {"build": build, **(info or {})}):
            raise LostBuild(f"set {number} under {self.root} was published by another writer")
        return store

    def current_or_build(self, write: Callable[[LayerStore], object]) -> LayerStore:
        """The newest set; where there is none, one is built, by whoever publishes first."""
        store = self.current()
        if store is None:
            try:
                store = self.build(write)
            except LostBuild:
                store = self.current()
        return store

    def prune(self, keep: int = 2) -> list[str]:
        """Delete the folders of all but the newest ``keep`` sets; no build may be under way."""
        whole = [c for n in self.manifests.numbers() if (c := self.manifests.content(n)) is not None]
        kept = {c["build"] for c in whole[-keep:]} if keep else set()
        gone = [b for b in self.manifests.folders(join_path(self.root, "builds")) if b not in kept]
        for build in gone:
            self.manifests.delete(join_path(self.root, "builds", build))
        return gone
