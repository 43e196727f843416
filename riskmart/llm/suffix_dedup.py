"""Removal of repeated substrings by suffix sorting (deep-shallow).

A byte goes when a string of ``LENGTH`` bytes that covers it also starts earlier (in a
document of smaller id, or in the same one).  Every such string starts a suffix; the
suffixes to sort are dealt so that equal strings meet:

1. A string's anchor is its ``GRAM``-byte substring of the smallest hash, the leftmost
   of equals.  Equal strings have equal anchors at equal offsets.  Neighbouring strings
   of one anchor occurrence form a segment of at most 64 string starts.
2. Anchors that occur once in the corpus have no repeated strings.  A bitmap of the
   others, sized by their number up to 32 MB (false hits only cost time), thins out the
   segments at the source.
3. Equal segments are collapsed: in all but the first occurrence every string is
   repeated.  Where an anchor has several different segments, their suffixes are
   sorted: multikey quicksort by 8-byte words to a shallow depth, then blind tries:
   a group skips to the first word in which any member differs from the first, and
   splits there.  Suffixes equal to the full length form a class; all but its earliest
   are repeated.  An anchor of very many different segments is compared by a grouping
   of its strings in Spark instead, so no group has to fit a task.
4. Flags go back to the documents, which drop the covered bytes.

Text is UTF-8 bytes.  Defined cases: null text is empty; a text shorter than
``LENGTH`` loses nothing; null ids come after all others; rows of one id with
different texts are ordered by a hash of the text; of rows that repeat id and text the
first counts as earlier; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import discard, mix, raw_texts, slices, stash, tidied, whole_text

LENGTH, GRAM, STARTS = 100, 37, 64          # a string has 64 places for a gram of 37 bytes
BITMAP_BITS = (20, 28)                      # the fewest and the most, as powers of two; 32 MB at most
GROUP_SEGMENTS = 50_000                     # different segments of an anchor that one task sorts
BATCH_BYTES = 2 << 20                       # of segments sorted at once; a byte takes some 50 of scratch
REMOVE_ROWS = 64                            # rows whose flags are worked on at once
PIECE = (1 << 20) - 256                     # string starts handled at once; positions fit 20 bits
_POSITION = np.uint64((1 << 20) - 1)
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_POWER = _powers(_MULTIPLIER, 1 << 20)
_INVERSE = _powers(pow(_MULTIPLIER, -1, 1 << 64), 1 << 20)


class Segments:
    """Anchor, segment hash, first string start, number of starts and anchor place of each segment of a text."""

    def __init__(self, data: bytes):
        found = [self._piece(np.frombuffer(data, np.uint8, min(len(data) - at, PIECE + LENGTH - 1), at), at)
                 for at in range(0, len(data) - LENGTH + 1, PIECE)]
        kinds = (np.uint64, np.uint64, np.int64, np.int64, np.int64)
        self.gram, self.key, self.start, self.starts, self.anchor = (
            np.concatenate(x) if found else np.zeros(0, k) for x, k in zip(list(zip(*found)) or [()] * 5, kinds))

    @staticmethod
    def _piece(data: np.ndarray, offset: int) -> tuple[np.ndarray, ...]:
        prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _POWER[: len(data)], out=prefix[1:])
        grams = len(data) - GRAM + 1
        h = mix((prefix[GRAM:] - prefix[:grams]) * _INVERSE[:grams])
        low = (h & ~_POSITION) | np.arange(grams, dtype=np.uint64)
        width = 1
        while width < STARTS:                           # minima over 2, 4, .. 64 places
            low = np.minimum(low[: len(low) - width], low[width:])
            width *= 2
        owner = (low & _POSITION).astype(np.int64)      # of every string start
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        starts = np.diff(np.append(first, len(owner)))
        anchor = owner[first]
        content = (prefix[first + starts - 1 + LENGTH] - prefix[first]) * _INVERSE[first]
        key = mix(content + mix((starts * 128 + anchor - first).astype(np.uint64)))
        return h[anchor], key, first + offset, starts, anchor + offset


# -- the bitmap ------------------------------------------------------------------------------

def bitmap(hashes: DataFrame, column: str, count: int) -> np.ndarray:
    """About 16 bits for each of ``count`` hashes, one set for each by its low bits: 2^22 words at most
    reach the driver.  (An anchor's high bits are small, since it is the least of many.)"""
    size = min(max((16 * count).bit_length(), BITMAP_BITS[0]), BITMAP_BITS[1])
    word = F.expr(f"shiftright({column} & {(1 << size) - 1}L, 6)").alias("word")
    bit = F.expr(f"shiftleft(1L, cast({column} & 63 as int))")
    rows = hashes.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (size - 6), np.int64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out.view(np.uint64)


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(bits) * 64 - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _place_hash(gram, key, doc_id, text_hash, anchor):
    """One hash of an occurrence; all arguments arrays or numbers of 64 bits."""
    return mix(gram ^ mix(key + mix(doc_id * np.uint64(3) + mix(text_hash ^ mix(anchor)))))


# -- jobs over texts -------------------------------------------------------------------------

def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [Segments(data).gram for data in raw_texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64) if found else [], pa.int64())],
                                         ["gram"])


_OCCURRENCE = "gram long, key long, id long, text_hash long, anchor long, start long, starts int"


def _occurrences(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(7)]
            for doc, key, data in zip(batch.column("id").to_pylist(), batch.column("text_hash").to_pylist(),
                                      raw_texts(batch.column("text"))):
                s = Segments(data)
                keep = np.flatnonzero(in_bitmap(shared.value, s.gram))
                for part, x in zip(out, (s.gram.view(np.int64)[keep], s.key.view(np.int64)[keep],
                                         np.full(len(keep), doc), np.full(len(keep), key), s.anchor[keep],
                                         s.start[keep], s.starts[keep].astype(np.int32))):
                    part.append(x)
            names = ["gram", "key", "id", "text_hash", "anchor", "start", "starts"]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else []).cast(
                pa.int32() if n == "starts" else pa.int64()) for n, x in zip(names, out)], names)
    return run


def _contents(wanted):
    """The bytes of the segments whose occurrence is in the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"gram": [], "key": [], "bytes": []}
            for doc, key, data in zip(batch.column("id").to_pylist(), batch.column("text_hash").to_pylist(),
                                      raw_texts(batch.column("text"))):
                s = Segments(data)
                doc, key = (np.array([x], np.int64).view(np.uint64) for x in (doc, key))
                keep = np.flatnonzero(in_bitmap(wanted.value, _place_hash(s.gram, s.key, doc, key,
                                                                          s.anchor.view(np.uint64))))
                out["gram"] += s.gram[keep].view(np.int64).tolist()
                out["key"] += s.key[keep].view(np.int64).tolist()
                out["bytes"] += [data[a: a + n + LENGTH - 1] for a, n in zip(s.start[keep].tolist(),
                                                                           s.starts[keep].tolist())]
            yield pa.RecordBatch.from_pydict(out, pa.schema([("gram", pa.int64()), ("key", pa.int64()),
                                                             ("bytes", pa.binary())]))
    return run


def _hash_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64)
                   for c in ("gram", "key", "id", "text_hash", "anchor")]
        yield pa.RecordBatch.from_arrays([pa.array(_place_hash(*columns).view(np.int64))], ["place"])


# -- the sort --------------------------------------------------------------------------------

_DEPTHS = [*range(0, LENGTH - 8, 8), LENGTH - 8]        # words of 8 bytes; the last overlaps
SHALLOW = 3


def deep_shallow(text: bytes, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort suffixes of ``text`` by their first ``LENGTH`` bytes.

    Returns their order and, for each place in it, the number of its class of equals.
    """
    padded = text + b"\0" * 8
    word = np.ndarray((len(text) + 1,), ">u8", padded, strides=(1,))
    order, group = np.arange(len(suffixes)), np.zeros(len(suffixes), np.int64)

    def refine(active: np.ndarray, values: np.ndarray) -> None:
        """Sort the places ``active`` (whole groups, ascending) by value within their group and split there."""
        sort = np.lexsort((values, group[active]))
        order[active] = order[active][sort]
        values, own = values[sort], group[active]
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (values[1:] != values[:-1])])
        # a group is named by its first place, so names keep ascending
        group[active] = active[np.maximum.accumulate(np.where(new, np.arange(len(active)), 0))]

    def unsettled() -> np.ndarray:
        same = group[1:] == group[:-1]
        return np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))

    # shallow: multikey quicksort, one word at a time, of groups that still tie
    active = np.arange(len(suffixes))
    for depth in _DEPTHS[:SHALLOW]:
        if len(active):
            refine(active, word[suffixes[order[active]] + depth].astype(np.uint64))
            active = unsettled()
    # deep: each group's blind trie skips the words all members share
    while len(active):
        heads = np.flatnonzero(np.concatenate([[True], group[active][1:] != group[active][:-1]]))
        sizes = np.diff(np.append(heads, len(active)))
        at = suffixes[order[active]]
        head = np.repeat(at[heads], sizes)
        branch = np.full(len(active), len(_DEPTHS))
        for k in range(len(_DEPTHS) - 1, SHALLOW - 1, -1):
            branch[word[at + _DEPTHS[k]] != word[head + _DEPTHS[k]]] = k
        branch = np.repeat(np.minimum.reduceat(branch, heads), sizes)
        open_ = branch < len(_DEPTHS)                   # the others are equal to the full length
        active, at, branch = active[open_], at[open_], branch[open_]
        if not len(active):
            break
        refine(active, word[at + np.array(_DEPTHS)[branch]].astype(np.uint64))
        same = group[active][1:] == group[active][:-1]
        active = active[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    return order, group


def repeated_starts(segments: list[bytes], rank: np.ndarray) -> list[int]:
    """For each segment (of ``rank`` among all by first place) the bits of its starts that a lower rank has too."""
    starts = np.array([len(s) - LENGTH + 1 for s in segments])
    begin = np.cumsum([0] + [len(s) for s in segments])[:-1]
    owner = np.repeat(np.arange(len(segments)), starts)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts)
    order, group = deep_shallow(b"".join(segments), begin[owner] + inside)
    heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    ranks = rank[owner[order]]
    lowest = np.repeat(np.minimum.reduceat(ranks, heads), np.diff(np.append(heads, len(ranks))))
    late = order[ranks > lowest]
    bits = np.zeros(len(segments), np.uint64)
    np.bitwise_or.at(bits, owner[late], np.uint64(1) << inside[late].astype(np.uint64))
    return bits.view(np.int64).tolist()


def _sorter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by gram; whole anchors are gathered to ``BATCH_BYTES`` or more and sorted together."""
    held, size, now = [], 0, None

    def done() -> pa.RecordBatch:
        place = np.array([r[3:] for r in held], np.int64)
        rank = np.empty(len(held), np.int64)
        rank[np.lexsort((place[:, 2], place[:, 1], place[:, 0]))] = np.arange(len(held))
        masks = repeated_starts([r[2] for r in held], rank)
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in held], pa.int64()),
                                           pa.array([r[1] for r in held], pa.int64()),
                                           pa.array(masks, pa.int64())], ["gram", "key", "mask"])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("gram", "key", "bytes", "id", "text_hash", "anchor"))):
            if row[0] != now and size >= BATCH_BYTES:
                yield done()
                held, size = [], 0
            now = row[0]
            held.append(row)
            size += len(row[2])
    if held:
        yield done()


def _sorted_masks(needed: DataFrame) -> DataFrame:
    return needed.repartition("gram").sortWithinPartitions("gram").mapInArrow(
        tidied(_sorter), "gram long, key long, mask long")


def _grouped_masks(needed: DataFrame) -> DataFrame:
    """The same by grouping the strings themselves: for anchors of very many segments."""
    strings = needed.select("gram", "key", F.struct("id", "text_hash", "anchor").alias("place"),
                            F.posexplode(F.transform(F.sequence(F.lit(1), F.octet_length("bytes") - LENGTH + 1),
                                                     lambda i: F.substring("bytes", i, LENGTH))).alias("i", "string"))
    first = stash(strings.groupBy("gram", "string").agg(F.min("place").alias("first"), F.count("*").alias("c"))
                  .where("c > 1").drop("c"), "repeat-strings")
    late = strings.join(first, ["gram", "string"]).where("place <> first")
    return late.groupBy("gram", "key").agg(F.bit_or(F.expr("shiftleft(1L, i)")).alias("mask"))


# -- removal ---------------------------------------------------------------------------------

def _flagged(flags: pa.ListArray) -> Iterator[np.ndarray]:
    """For each row the places of its repeated strings, from its segments' starts and masks."""
    ends, whole = flags.offsets.to_numpy(), flags.values
    start, starts, mask = (whole.field(c).to_numpy(zero_copy_only=False) for c in ("start", "starts", "mask"))
    inside = np.arange(STARTS)
    for a, b, known in zip(ends[:-1].tolist(), ends[1:].tolist(), flags.is_valid().to_pylist()):
        if not known or a == b:
            yield np.zeros(0, np.int64)
            continue
        bits = np.unpackbits(mask[a:b].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(bool)
        row, place = np.nonzero(bits & (inside < starts[a:b, None]))
        yield start[a:b][row] + place


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, REMOVE_ROWS)):
        out = {k: [] for k in ("id", "text_hash", "n_bytes", "n_removed", "n_spans", "kept_sha256")}
        for doc, key, data, at in zip(batch.column("id").to_pylist(), batch.column("text_hash").to_pylist(),
                                      raw_texts(batch.column("text")), _flagged(batch.column("flags"))):
            kept, removed, spans = data, 0, 0
            if len(at):
                step = np.zeros(len(data) + 1, np.int8)         # no place starts or ends two strings
                step[at] += 1
                step[at + LENGTH] -= 1
                gone = np.cumsum(step[:-1], dtype=np.int32) > 0
                removed = int(gone.sum())
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            for k, v in zip(out, (doc, key, len(data), removed, spans, hashlib.sha256(kept).hexdigest())):
                out[k].append(v)
        yield pa.RecordBatch.from_pydict(out, pa.schema([
            ("id", pa.int64()), ("text_hash", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
            ("n_spans", pa.int64()), ("kept_sha256", pa.string())]))


_LAST = (1 << 63) - 1


def removals(docs: DataFrame, group_segments: int = GROUP_SEGMENTS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    # a null id takes the last place; what is left of it shows in the result only
    place: Column = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    texts = docs.select(place.alias("id"), F.xxhash64(whole_text()).alias("text_hash"), whole_text().alias("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(whole_text()).alias("text_hash"))
    copies = stash(rows.groupBy("doc_id", "text_hash").agg(F.count("*").alias("copies")).where("copies > 1"),
                   "repeat-rows")
    repeated = not copies.isEmpty()
    if repeated:                                        # one row of each stands for all
        texts = texts.dropDuplicates(["id", "text_hash"])

    shared = stash(texts.select("text").mapInArrow(tidied(_grams), "gram long").groupBy("gram").agg(F.count("*").alias("n"))
                   .where("n > 1").select("gram"), "shared-anchors")
    bits = spark.sparkContext.broadcast(bitmap(shared, "gram", shared.count()))
    found = stash(texts.mapInArrow(tidied(_occurrences(bits)), _OCCURRENCE), "occurrences")
    order = F.struct("id", "text_hash", "anchor")
    segments = stash(found.groupBy("gram", "key").agg(F.min(order).alias("first"), F.count("*").alias("n"))
                     .select("gram", "key", "first.*", "n"), "segments")
    several = stash(segments.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1"), "mixed-anchors")
    needed = stash(segments.drop("n").join(several, "gram"), "needed-segments")

    places = needed.select("gram", "key", "id", "text_hash", "anchor").mapInArrow(tidied(_hash_places), "place long")
    wanted = spark.sparkContext.broadcast(bitmap(places, "place", needed.count()))
    contents = texts.mapInArrow(tidied(_contents(wanted)), "gram long, key long, bytes binary")
    contents = stash(contents.dropDuplicates(["gram", "key"]).join(needed, ["gram", "key"]), "contents")
    masks = _sorted_masks(contents.where(F.col("kinds") <= group_segments))
    many = contents.where(F.col("kinds") > group_segments)
    if not many.isEmpty():
        masks = masks.unionByName(_grouped_masks(many))

    told = segments.join(masks, ["gram", "key"], "left").select(
        "gram", "key", F.struct("id", "text_hash", "anchor").alias("first"), "n",
        F.coalesce("mask", F.lit(0).cast("long")).alias("mask")).where("n > 1 or mask <> 0")
    told = stash(told.select("gram", "key", "first", "mask"), "repeats")
    flags = (found.join(told, ["gram", "key"])
             .withColumn("mask", F.when(order == F.col("first"), F.col("mask")).otherwise(F.lit(-1).cast("long")))
             .where("mask <> 0").groupBy(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"))
             .agg(F.collect_list(F.struct("start", "starts", "mask")).alias("flags")))
    flags = stash(flags, "flags")
    discard(shared, found, segments, several, needed, contents, told)
    done = texts.join(flags, (F.col("id") == F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left").select(
        "id", "text_hash", "text", "flags").mapInArrow(
        tidied(_remove), "id long, text_hash long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    done = done.withColumn("doc_id", F.when(F.col("id") != _LAST, F.col("id")))
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    if not repeated:
        return done.select(*columns)
    # later rows that repeat id and text are repeated as a whole, if they hold a string at all
    joined = done.join(copies.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"}),
                       F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    joined = joined.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.coalesce("copies", F.lit(1)).cast("int"))))
    gone = (F.col("copy_no") > 1) & (F.col("n_bytes") >= LENGTH)
    return joined.select(
        "doc_id", "n_bytes", F.when(gone, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(gone, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"))
