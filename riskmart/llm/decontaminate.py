"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

Every text is searched for the word n-grams of the test items; stretches around hits
are kept with their words.  Over all documents, the document frequency of each
n-gram is counted, and of every ``spread`` neighbouring n-grams of an item the rarest
that occurs becomes a seed, so any copied run of ``n + spread - 1`` words holds one however often
it leaked.  Stretches with a seed are aligned with the seed's items; a pair whose
score reaches ``share`` of the item's best score, or that of ``enough`` words, counts.

The items are held in tasks and on the driver in blocks of ``block_words`` words at
most; a larger benchmark takes several blocks, and as many passes.

Words are lower-cased in ASCII and lose surrounding punctuation; a word of
punctuation alone is none.  Defined cases: null or empty texts and items match
nothing; a null id is carried on; a row that repeats counts once for its id; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm.common import WordHashes, as_rows, raw_texts, rows_back, shingle_hashes, stash, tidied, whole_text

EDGES = b"".join(bytes([c]) for c in range(33, 127) if not chr(c).isalnum())
MATCH, MISMATCH, GAP = 2, -1, 1


@dataclass(frozen=True)
class Settings:
    n: int = 4
    spread: int = 2
    share: float = 0.5
    enough: int = 25
    block_words: int = 1_000_000


class Words(WordHashes):
    """Hashes of lower-cased words without surrounding punctuation; 0 for a word that is nothing else."""

    def value(self, word: bytes) -> int:
        bare = word.strip(EDGES)
        return super().value(bare) if bare else 0

    def text(self, data: bytes) -> np.ndarray:
        out = self.of(data.lower().split())
        return out[out != 0]


class Items:
    """The test items of one block: word hashes, and where each n-gram occurs."""

    def __init__(self, rows: list[tuple[int | None, bytes]], n: int):
        words = Words()
        held = [(i, w) for i, w in ((i, words.text(t)) for i, t in rows) if len(w)]
        self.ids, self.words = [i for i, _ in held], [w for _, w in held]
        self.n = n
        grams = [shingle_hashes(w, n) for w in self.words]
        self.sizes = sorted({min(n, len(w)) for w in self.words})
        self.gram = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        self.item = np.repeat(np.arange(len(grams)), [len(g) for g in grams]).astype(np.int64)
        self.keys = np.unique(self.gram)
        self.margin = max(map(len, self.words), default=0)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, number of the n-gram among ``keys``) of every hit, by position."""
        at, key = [], []
        for size in self.sizes:
            if len(words) < size:
                continue
            h = shingle_hashes(words, size)
            p = np.flatnonzero(self.maybe[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
            k = np.minimum(np.searchsorted(self.keys, h[p]), len(self.keys) - 1)
            good = self.keys[k] == h[p]
            at.append(p[good]), key.append(k[good])
        if not at:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, key = np.concatenate(at), np.concatenate(key)
        order = np.argsort(at, kind="stable")
        return at[order], key[order]

    def seeds(self, frequency: np.ndarray, spread: int) -> tuple[np.ndarray, np.ndarray]:
        """(n-gram number, item) of the rarest n-gram of every ``spread`` neighbours of an item."""
        number = np.searchsorted(self.keys, self.gram)
        rank = np.empty(len(self.keys), np.int64)
        rank[np.lexsort((self.keys, frequency, frequency == 0))] = np.arange(len(self.keys))    # of those that occur
        found = set()
        bounds = np.searchsorted(self.item, np.arange(len(self.words) + 1))
        for item, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            r = rank[number[a:b]]
            width = min(spread, b - a)
            best = np.lib.stride_tricks.sliding_window_view(r, width).argmin(1) + np.arange(b - a - width + 1)
            found.update((int(g), item) for g in np.unique(number[a:b][best]))
        pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]


def align(text: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: score, and first and past-last word in ``text``."""
    def best(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
        slope = GAP * np.arange(len(a) + 1)
        row, top, end = np.zeros(len(a) + 1, np.int64), 0, 0
        for w in b:
            new = np.zeros(len(a) + 1, np.int64)
            new[1:] = np.maximum(row[:-1] + np.where(a == w, MATCH, MISMATCH), row[1:] - GAP)
            np.maximum(new, 0, out=new)
            row = np.maximum.accumulate(new + slope) - slope     # gaps inside the text
            k = int(row.argmax())
            if row[k] > top:
                top, end = int(row[k]), k
        return top, end

    score, end = best(text, item)
    _, back = best(text[:end][::-1], item[::-1])
    return score, end - back, end


_REGION = "doc_id long, text_hash long, start long, words array<long>, grams array<int>"


def _finder(rows: list[tuple[int | None, bytes]], n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, words = Items(rows, n), Words()
        for batch in batches:
            out = {k: [] for k in ("doc_id", "text_hash", "start", "words", "grams")}
            for doc, key, data in zip(batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist(),
                                      raw_texts(batch.column("text"))):
                w = words.text(data)
                at, gram = items.hits(w)
                if not len(at):
                    continue
                # hits less than two margins apart share a stretch
                cuts = np.flatnonzero(np.diff(at) > 2 * items.margin) + 1
                for p, g in zip(np.split(at, cuts), np.split(gram, cuts)):
                    a = max(0, int(p[0]) - items.margin)
                    part = w[a: int(p[-1]) + n + items.margin]
                    for k, v in zip(out, (doc, key, a, part.view(np.int64), np.unique(g).astype(np.int32))):
                        out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, pa.schema([
                ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int64()),
                ("words", pa.list_(pa.int64())), ("grams", pa.list_(pa.int32()))]))
    return run


_PAIR = "doc_id long, text_hash long, item long, score long, share double, first_word long, end_word long"


def _aligner(rows: list[tuple[int | None, bytes]], settings: Settings, gram: np.ndarray, of_item: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(rows, settings.n)
        for batch in batches:
            out = {k: [] for k in ("doc_id", "text_hash", "item", "score", "share", "first_word", "end_word")}
            for doc, key, start, words, grams in zip(*(batch.column(c) for c in batch.schema.names)):
                words = np.asarray(words.values).view(np.uint64)
                seeded = np.isin(gram, np.asarray(grams.values))
                for i in np.unique(of_item[seeded]).tolist():
                    item = items.words[i]
                    score, a, b = align(words, item)
                    if score >= MATCH * min(settings.share * len(item), settings.enough):
                        for k, v in zip(out, (doc.as_py(), key.as_py(), i, score, score / (MATCH * len(item)),
                                              start.as_py() + a, start.as_py() + b)):
                            out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, pa.schema([
                ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("item", pa.int64()), ("score", pa.int64()),
                ("share", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())]))
    return run


def blocks_of(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[int | None, bytes]]]:
    """The items, repeats once, in lists of about ``block_words`` words at most."""
    items = stash(benchmark.select(F.col("item_id").cast("long").alias("item_id"), whole_text().alias("text")).distinct(),
                  "items")
    total = items.agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).first()["n"] or 0
    count = -(-2 * total // block_words) or 1
    for k in range(count):
        part = items if count == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        yield sorted(((r["item_id"], r["text"].encode()) for r in part.collect()),
                     key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def matches(spark: SparkSession, docs: DataFrame, benchmark: DataFrame,
            settings: Settings = Settings()) -> DataFrame:
    """(doc_id, text_hash, item_id, score, share, first_word, end_word): the best alignment of every
    document and item that reaches the threshold."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(whole_text()).alias("text_hash"),
                        whole_text().alias("text"))
    found = []
    for rows in blocks_of(benchmark, settings.block_words):
        items = Items(rows, settings.n)
        regions = stash(texts.mapInArrow(tidied(_finder(rows, settings.n)), _REGION), "regions")
        # a row for each n-gram of the block at most
        counts = (regions.select("doc_id", "text_hash", F.explode("grams").alias("g")).groupBy("g")
                  .agg(F.count("*").alias("n")).collect())
        frequency = np.zeros(len(items.keys), np.int64)
        for g, n in counts:
            frequency[g] = n
        gram, of_item = items.seeds(frequency, settings.spread)
        names = spark.createDataFrame(list(enumerate(items.ids)), "item long, item_id long")
        found.append(regions.mapInArrow(tidied(_aligner(rows, settings, gram, of_item)), _PAIR)
                     .join(names, "item").drop("item"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    key = ["doc_id", "text_hash", "item_id"]
    best = F.max(F.struct("score", "share", (-F.col("first_word")).alias("f"), "end_word")).alias("b")
    return every.groupBy(*key).agg(best).select(
        *key, "b.score", "b.share", (-F.col("b.f")).alias("first_word"), "b.end_word")


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns."""
    hits = stash(matches(spark, docs, benchmark, settings).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "leaks")
    rows = as_rows(docs, row_id=F.col("doc_id").cast("long"), row_hash=F.xxhash64(whole_text()))
    return rows_back(rows.join(hits, F.col("row_id").eqNullSafe(F.col("_id")) & (
        F.col("row_hash") == F.col("_hash")), "left_anti"), docs)
