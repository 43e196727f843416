"""Quality classifier by importance resampling (hashed n-gram models, Gumbel top-k).

Two generative models count hashed n-grams: the raw model over all documents, the
target model over labelled documents of good quality.  N-grams are words (without
case and surrounding punctuation) and, of each word's shape (letters as ``a`` or
``A``, digits as ``9``, other characters as they are, runs once), single shapes and
pairs, and whether a word repeats the one before.  The log importance weight of a
document is ``sharpness`` times its mean log ratio of target to raw probability, so
that length alone decides nothing; Gumbel noise from a hash of the row is added and
the k rows of the largest sums are the sample.  k is the number of rows whose ratio
is on the good side of the cut that best parts labelled good from bad documents.

A mean over a document does not show a few abusive words in good prose, so toxicity is
a score of its own: the greatest weight of a document's words (32-bit hashes).  A word's
weight is how much likelier a toxic than a clean document of good quality has it, as a
log ratio less two standard errors.  Rows whose toxicity reaches the cut that best parts
labelled toxic from clean documents are no candidates of the sample.

The target model, the words' weights and the cuts are fitted on at most ``label_rows``
labelled documents (those of the smallest hash); each is scored by a model that it is
not part of.  Raw counts, scores and the top-k cover every row.  Counts are arrays of
fixed size, added up by Spark; the driver gets one row for each bucket at most, and the
words of positive weight.

Defined cases: a null or empty text has ratio 0; a null id is a row like others (no
label); rows that repeat share their fate, as do ties at the k-th place (all stay);
without labels of both kinds every row stays; without labelled toxic and clean documents,
or where no cut parts them, none is toxic; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import WordHashes, as_rows, raw_texts, rows_back, stash, tidied, whole_text

WORD_BUCKETS, SHAPE_BUCKETS = 1 << 16, 1 << 14
BUCKETS = WORD_BUCKETS + SHAPE_BUCKETS
_EDGES = b"".join(bytes([c]) for c in range(33, 127) if not chr(c).isalnum())
_KINDS = bytes(97 if 97 <= c < 123 or c >= 128 else 65 if 65 <= c < 91 else 57 if 48 <= c < 58 else c for c in range(256))
_RUNS = re.compile(rb"(.)\1+", re.S)


@dataclass(frozen=True)
class Settings:
    label_rows: int = 20_000
    prior: float = 5.0          # n-grams of raw text that every bucket's target count is drawn towards
    sharpness: float = 50.0
    seed: int = 17


class Shapes(WordHashes):
    """The kind of each byte of a word -> hash of its shape in the high half; words have few shapes."""

    def value(self, kinds: bytes) -> int:
        return (super().value(b"\1" + _RUNS.sub(rb"\1", kinds)) % (1 << 30)) << 32


class Grams(WordHashes):
    """Bytes of a word -> hashes of the word (low half) and of its shape (high half), as one number."""

    def __init__(self):
        super().__init__()
        self.shapes = Shapes(100_000)
        self.begun = hashlib.blake2b(b"\0", digest_size=8, key=self.seed)

    def value(self, word: bytes) -> int:
        bare = self.begun.copy()
        bare.update(word.lower().strip(_EDGES))
        return int.from_bytes(bare.digest()[:4], "little") | self.shapes[word.translate(_KINDS)]

    def words(self, data: bytes) -> np.ndarray:
        """The hashes of a text's words, in order."""
        return (self.of(data.split()) & np.uint64(0xFFFFFFFF)).astype(np.int64)

    def text(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of a text's n-grams, and the hashes of its words."""
        both = self.of(data.split())
        if not len(both):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        word, shape = (both & np.uint64(0xFFFFFFFF)).astype(np.int64), (both >> np.uint64(32)).astype(np.int64)
        before = np.concatenate([[0], shape[:-1]])
        again = np.concatenate([[False], both[1:] == both[:-1]])
        shaped = np.concatenate([shape, shape * 31 + before * 17 + 7, np.where(again, 3, 5)])
        return np.concatenate([word % WORD_BUCKETS, WORD_BUCKETS + shaped % SHAPE_BUCKETS]), word


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, grams = np.zeros((3, BUCKETS), np.int64), Grams()
    for batch in batches:
        for data, fold in zip(raw_texts(batch.column("text")), batch.column("fold").to_pylist()):
            found, _ = grams.text(data)
            np.add.at(total[0], found, 1)
            if fold is not None and fold >= 0:
                np.add.at(total[1 + fold], found, 1)
    at = np.flatnonzero(total[0])
    yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(t[at]) for t in total)],
                                     ["bucket", "raw", "fold0", "fold1"])


def log_ratio(target: np.ndarray, raw: np.ndarray, prior: float) -> np.ndarray:
    """log of target to raw probability of each bucket, drawn towards 0 where the raw count is small."""
    share = max(target.sum(), 1) / max(raw.sum(), 1)
    return np.log((target + prior * share) / ((raw + prior) * share))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each batch: in how many toxic and clean documents of each part a word is."""
    grams = Grams()
    for batch in batches:
        kinds = [2 * t + p for t, p in zip(batch.column("toxic").to_pylist(), batch.column("part").to_pylist())]
        words = [np.unique(grams.words(data)) for data in raw_texts(batch.column("text"))]
        every = np.concatenate([np.zeros(0, np.int64), *words])
        word, at = np.unique(every, return_inverse=True)
        counts = np.zeros((4, len(word)), np.int64)
        np.add.at(counts, (np.repeat(np.array(kinds, np.int64), [len(w) for w in words]), at), 1)
        yield pa.RecordBatch.from_arrays([pa.array(word), *map(pa.array, counts)], ["word", *WORD_COUNTS])


WORD_COUNTS = ("clean0", "clean1", "toxic0", "toxic1")


def toxic_words(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the words that speak for toxicity, and a row of their weights for each model.

    The first two models are of the other part's documents, the third is the mean of both, so
    that the cut found with halves holds for it too.
    """
    texts = texts.where("toxic is not null")
    sizes = {(r["toxic"], r["part"]): r["n"] for r in texts.groupBy("toxic", "part").agg(F.count("*").alias("n")).collect()}
    counts = texts.select("text", F.col("toxic").cast("int").alias("toxic"), "part").mapInArrow(
        tidied(_word_counts), "word long, " + ", ".join(f"{c} long" for c in WORD_COUNTS)).groupBy("word").agg(
        *(F.sum(c).alias(c) for c in WORD_COUNTS))

    def weight(part: int):
        t, c = F.col(f"toxic{part}") + 0.5, F.col(f"clean{part}") + 0.5
        base = np.log((sizes.get((False, part), 0) + 0.5) / (sizes.get((True, part), 0) + 0.5))
        found = F.log(t / c) + float(base) - 2 * F.sqrt(1 / t + 1 / c)
        return F.when(F.col(f"toxic{part}") > 0, F.greatest(found, F.lit(0.0))).otherwise(0.0)

    rows = counts.select("word", weight(1).alias("w0"), weight(0).alias("w1")).where("w0 > 0 or w1 > 0").collect()
    rows.sort()
    weights = np.array([[r["w0"], r["w1"]] for r in rows]).reshape(-1, 2).T
    return np.array([r["word"] for r in rows], np.int64), np.concatenate([weights, weights.mean(0, keepdims=True)])


def _scorer(models: np.ndarray, toxic: np.ndarray, weights: np.ndarray):
    maybe = np.zeros(WORD_BUCKETS, bool)                      # most words end here
    maybe[toxic % WORD_BUCKETS] = True

    def toxicity(words: np.ndarray, model: int) -> float:
        words = words[maybe[words % WORD_BUCKETS]]
        if not len(words):
            return 0.0
        at = np.minimum(np.searchsorted(toxic, words), len(toxic) - 1)
        return float(np.where(toxic[at] == words, weights[model, at], 0.0).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in batches:
            out, bad = [], []
            for data, fold in zip(raw_texts(batch.column("text")), batch.column("scored_by").to_pylist()):
                found, words = grams.text(data)
                model = 2 if fold is None else fold
                out.append(float(models[model][found].sum()) / (len(found) + 8))
                bad.append(toxicity(words, model))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "text_hash", "good", "toxic")), pa.array(out, pa.float64()),
                 pa.array(bad, pa.float64())],
                ["doc_id", "text_hash", "good", "toxic", "ratio", "toxicity"])
    return run


def labelled(labels: DataFrame, rows: int) -> DataFrame:
    """(id, good, toxic, part): at most ``rows`` labelled ids, those of the smallest hash, in two parts."""
    found = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        (F.coalesce(F.min(F.col("quality").cast("int")), F.lit(0)) > 0).alias("fine"),
        F.coalesce(F.max(F.col("toxic").cast("int")), F.lit(0)).alias("toxic"))
    found = found.select("id", "fine", "toxic").orderBy(F.xxhash64("id", F.lit(3)), "id").limit(rows)
    # good: taken as target text; bad: of poor quality; toxic prose of good quality is neither, but has a label of its own
    return found.select("id", F.when(F.col("fine") & (F.col("toxic") == 0), True).when(~F.col("fine"), False).alias("good"),
                        F.when(F.col("fine"), F.col("toxic") != 0).alias("toxic"),
                        F.pmod(F.xxhash64("id", F.lit(5)), F.lit(2)).cast("int").alias("part"))


def best_cut(good: np.ndarray, bad: np.ndarray, edges: np.ndarray) -> float:
    """The middle of the cuts that keep most of the good and drop most of the bad (counts for each bin)."""
    kept = 1 - np.concatenate([[0], np.cumsum(good)]) / good.sum()
    dropped = np.concatenate([[0], np.cumsum(bad)]) / bad.sum()
    value = kept + dropped
    best = edges[np.flatnonzero(value >= value.max() - 1e-12)]
    return float((best[0] + best[-1]) / 2)


def scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, float | None]:
    """(doc_id, text_hash, good, toxic, ratio, toxicity) of every row, written; and the cut of the ratio, None without
    labels of both kinds."""
    # a bounded table by its limit
    known = F.broadcast(stash(labelled(labels, settings.label_rows), "quality-labels"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(whole_text()).alias("text_hash"),
                        whole_text().alias("text")).join(known, F.col("doc_id") == F.col("id"), "left")
    fold = F.when(F.col("good"), F.col("part"))
    counts = texts.select("text", fold.alias("fold")).mapInArrow(
        tidied(_count), "bucket long, raw long, fold0 long, fold1 long").groupBy("bucket").agg(
        *(F.sum(c).alias(c) for c in ("raw", "fold0", "fold1"))).collect()
    total = np.zeros((3, BUCKETS))
    for bucket, *n in counts:
        total[:, bucket] = n
    # a labelled row is scored by the other part's model, any other by both together
    models = np.stack([log_ratio(total[2], total[0], settings.prior), log_ratio(total[1], total[0], settings.prior),
                       log_ratio(total[1] + total[2], total[0], settings.prior)])
    if not total[1].sum() or not total[2].sum():
        models[:2] = models[2]
    if not total[1:].sum():
        models[:] = 0
    found = stash(texts.select("doc_id", "text_hash", "text", "good", "toxic", F.col("part").alias("scored_by")).mapInArrow(
        tidied(_scorer(models, *toxic_words(texts))),
        "doc_id long, text_hash long, good boolean, toxic boolean, ratio double, toxicity double"), "quality-scores")
    edges = np.linspace(-12, 4, 4097)
    bins = F.least(F.greatest(F.floor((F.col("ratio") + 12) * 256), F.lit(0)), F.lit(4095)).cast("int")
    seen = np.zeros((2, 4096))
    for good, at, n in found.where("good is not null").groupBy("good", bins.alias("bin")).count().collect():
        seen[int(good), at] = n
    return found, best_cut(seen[1], seen[0], edges) if seen.sum(1).all() else None


def toxic_cut(found: DataFrame) -> float | None:
    """The toxicity from which a row is toxic; None without labels of both kinds, or where no cut parts them."""
    edges = np.linspace(0, 16, 4097)
    bins = F.least(F.floor(F.col("toxicity") * 256), F.lit(4095)).cast("int")
    seen = np.zeros((2, 4096))
    for toxic, at, n in found.where("toxic is not null").groupBy("toxic", bins.alias("bin")).count().collect():
        seen[int(toxic), at] = n
    if not seen.sum(1).all():
        return None
    cut = best_cut(seen[1], seen[0], edges)
    reached = edges[:-1] >= cut
    return cut if (seen[:, reached].sum(1) / seen.sum(1)) @ [-1, 1] > 0 else None


def gumbel_keys(found: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows with ``sample_key``: the log weight and Gumbel noise that depends on id, text and seed alone."""
    # 52 bits, and half a step, so that neither 0 nor 1 comes up
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", "text_hash", F.lit(settings.seed)), 12) + 0.5) / float(1 << 52)
    return found.withColumn("log_weight", settings.sharpness * F.col("ratio")).withColumn(
        "sample_key", F.col("log_weight") - F.log(-F.log(u)))


def kth_largest(keys: DataFrame, column: str, k: int, bins: int = 4096) -> float:
    """The exact k-th largest value: histograms that narrow to the bin that holds it."""
    low, high, n = keys.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n or k >= n:
        return float("-inf") if not n else low
    while low < high:
        width = (high - low) / bins
        if not width or low + width == low or high - width == high:
            values = keys.where(F.col(column).between(low, high)).groupBy(column).count().orderBy(F.desc(column))
            above = keys.where(F.col(column) > high).count()
            for value, count in values.collect():      # values no wider apart than doubles are: a bin's worth at most
                above += count
                if above >= k:
                    return value
            return low
        at = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1))
        inside = keys.where(F.col(column).between(low, high))
        above = keys.where(F.col(column) > high).count()
        spans = inside.groupBy(at.cast("int").alias("bin")).agg(
            F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
        for row in sorted(spans, key=lambda r: -r["bin"]):
            above += row["n"]
            if above >= k:
                low, high = row["low"], row["high"]
                break
    return low


def sampled(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, text_hash, ratio, toxicity, log_weight, sample_key) of the rows that are kept."""
    found, cut = scores(docs, labels, settings)
    toxic_from = toxic_cut(found)
    if toxic_from is not None:
        found = found.where(F.col("toxicity") < toxic_from)
    keys = gumbel_keys(found, settings).drop("good", "toxic")
    if cut is None:
        return keys
    keys = stash(keys, "quality-keys")
    k = keys.where(F.col("ratio") >= cut).count()
    return keys.where(F.col("sample_key") >= kth_largest(keys, "sample_key", k)) if k else keys.limit(0)


def kept(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that the sample keeps, with all their columns."""
    stays = stash(sampled(docs, labels, settings).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "quality-kept")
    rows = as_rows(docs, row_id=F.col("doc_id").cast("long"), row_hash=F.xxhash64(whole_text()))
    return rows_back(rows.join(stays, F.col("row_id").eqNullSafe(F.col("_id")) & (
        F.col("row_hash") == F.col("_hash")), "left_semi"), docs)
