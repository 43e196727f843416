"""Token ids in files of canonical, length-limited Huffman codes.

File format (a folder of Parquet files, so that any store Spark reads will do):

* ``lengths``: one row for each id that occurs: id, count, bits.  The canonical code
  follows from ``bits`` alone: ids sorted by (bits, id) get consecutive codes.
* ``blocks``: file, block, first (ids of earlier blocks of the file), n_ids, the
  documents and their lengths in the block, ``piece`` of ``pieces`` (which part of a
  document larger than a block this is; else 0 of 1), the packed bits, and the bit offset of every
  ``STEP``-th id.  Files follow ascending doc_id; a block stands for itself.
* ``files``: file, n_ids.

Decoding looks up the next ``limit`` bits in one table (id, bits); all checkpoints
of a batch of blocks advance together, one id a step.

Defined cases: null text is empty and holds the end id alone; null doc_ids come
first; rows that repeat an id are ordered by their ids' crc32; an empty table
gives empty files; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskmart.llm.common import new_path, raw_texts, slices, tidied, whole_text
from riskmart.llm.wordwise import wordwise

LIMIT = 16        # longest code; raised where more ids occur than fit
BLOCK_IDS = 1 << 16
STEP = 128        # ids between two checkpoints
END_ID = 2


# -- the code ---------------------------------------------------------------------------

def limited_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Code length of each symbol: least total bits with no code over ``limit`` (package-merge).

    Level by level, pairs of the cheapest items become packages that compete with
    the single symbols again; a symbol's length is how often it is in the items chosen.
    """
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need codes of more than {limit} bits")
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.float64)
    levels = []               # for each level, which merged items are single symbols
    items = weights
    for _ in range(limit - 1):
        pairs = items[: len(items) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, pairs])
        sort = np.argsort(both, kind="stable")
        levels.append(sort < n)
        items = both[sort]
    lengths = np.zeros(n, np.int64)
    take = 2 * (n - 1)        # items used of the last level; each package asks for two of the one before
    for single in reversed(levels):
        singles = int(single[:take].sum())
        lengths[:singles] += 1
        take = 2 * (take - singles)
    lengths[:take] += 1
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


@dataclass
class Codebook:
    """Canonical codes of ``ids`` (ascending) with their ``bits``."""

    ids: np.ndarray
    bits: np.ndarray

    def __post_init__(self):
        self.limit = int(self.bits.max()) if len(self.bits) else 1
        order = np.lexsort((self.ids, self.bits))
        widths = self.bits[order]
        steps = np.left_shift(1, self.limit - widths)             # share of the code space
        starts = np.concatenate([[0], np.cumsum(steps)[:-1]]) if len(order) else np.zeros(0, np.int64)
        size = int(self.ids.max()) + 1 if len(self.ids) else 1
        self.code, self.width = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code[self.ids[order]] = (starts >> (self.limit - widths)).astype(np.uint64)
        self.width[self.ids[order]] = widths
        self.table = np.ones(1 << self.limit, np.int64)           # the id that bits begin with, times 32, and its width
        self.table[: int(steps.sum())] = np.repeat(self.ids[order].astype(np.int64) << 5 | widths, steps)

    def pack(self, ids: np.ndarray, step: int = STEP) -> tuple[bytes, np.ndarray]:
        """The bits of ``ids`` as bytes, and the bit offset of every ``step``-th id."""
        width = self.width[ids]
        ends = np.cumsum(width)
        at = ends - width
        total = int(ends[-1]) if len(ids) else 0
        placed = self.code[ids] << (64 - width - (at & 31)).astype(np.uint64)
        word = at >> 5
        out = np.zeros((total >> 5) + 2)
        out += np.bincount(word, weights=(placed >> np.uint64(32)).astype(np.float64), minlength=len(out))
        out += np.bincount(word + 1, weights=(placed & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=len(out))
        return out.astype(">u4").tobytes()[: (total + 7) // 8], at[::step].astype(np.int32)

    def unpack(self, blocks: list[tuple[bytes, np.ndarray, int]], step: int = STEP) -> list[np.ndarray]:
        """The ids of each (bits, checkpoints, number of ids); all checkpoints advance together."""
        base, parts, lanes, left = 0, [], [], []
        for data, marks, n in blocks:
            padded = data + b"\0" * (8 - len(data) % 4)
            parts.append(padded)
            lanes.append(marks.astype(np.int64) + 8 * base)
            left.append(np.minimum(step, n - np.arange(len(marks)) * step))
            base += len(padded)
        if not base or not sum(map(len, lanes)):
            return [np.zeros(0, np.uint32) for _ in blocks]
        at, left = np.concatenate(lanes), np.concatenate(left)    # short lanes run on over what follows, unread
        most = int(left.max())
        parts.append(b"\0" * (4 * most + 8))                      # no code is longer than 31 bits
        half = np.frombuffer(b"".join(parts), ">u2").astype(np.int64)
        window = half[:-1] << 16 | half[1:]
        found = np.zeros((step, len(at)), np.int64)
        keep, room = (1 << self.limit) - 1, 32 - self.limit
        for k in range(most):
            found[k] = self.table[window[at >> 4] >> (room - (at & 15)) & keep]
            at += found[k] & 31
        out, lane = [], 0
        for _, marks, n in blocks:
            out.append((found[:, lane: lane + len(marks)].T >> 5).astype(np.uint32).reshape(-1)[:n])
            lane += len(marks)
        return out


# -- writing ----------------------------------------------------------------------------

def _tokenizer(path: str, end_id: int):
    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = wordwise(path)
        for whole in batches:
            for batch in slices(whole, 1000):
                every, cuts = encoder.encode_column(batch.column("text"))
                every = np.insert(every, cuts[1:], end_id)
                if every.max(initial=0) > 0xFFFF:
                    raise ValueError(f"token id {every.max()} does not fit 16 bits")
                cuts = cuts + np.arange(len(cuts))                # each text has its end id now
                spans, small = list(zip(cuts[:-1].tolist(), cuts[1:].tolist())), every.astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(np.diff(cuts), pa.int64()),
                     pa.array([zlib.crc32(every[a:b]) for a, b in spans], pa.int64()),
                     pa.array([small[a:b].tobytes() for a, b in spans], pa.binary())],
                    ["doc_id", "n_tokens", "crc", "ids"])
    return tokenize


def tokens(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, n_tokens, crc, ids): ids of each text and the end id, 16 bits each; a greater id is an error."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(
        tidied(_tokenizer(tokenizer_path, end_id)), "doc_id long, n_tokens long, crc long, ids binary")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 16, np.int64)
    for batch in batches:
        total += np.bincount(np.frombuffer(b"".join(raw_texts(batch.column("ids"))), "<u2"), minlength=1 << 16)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(total[at])], ["id", "n"])


def codebook(ids: DataFrame, limit: int = LIMIT) -> Codebook:
    """The code for the counts over all of ``ids``; at most 65,536 rows, one for each id, reach the driver."""
    counts = ids.select("ids").mapInArrow(tidied(_count), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts.sort()
    number, n = np.array([r[0] for r in counts], np.int64), np.array([r[1] for r in counts], np.int64)
    return Codebook(number, limited_lengths(n, limit))


_BLOCK = ("file int, block long, first long, n_ids long, piece int, pieces int, doc_ids array<long>, doc_lens array<long>, "
          "bits binary, marks array<int>")


def _packer(ids: np.ndarray, bits: np.ndarray, block_ids: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        book, file = Codebook(ids, bits), TaskContext.get().partitionId()
        docs, lens, parts, held, block, first = [], [], [], 0, 0, 0

        def flush(piece: int, pieces: int) -> pa.RecordBatch:
            nonlocal docs, lens, parts, held, block, first
            values = np.concatenate(parts)
            data, marks = book.pack(values)
            out = pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([block], pa.int64()), pa.array([first], pa.int64()),
                 pa.array([len(values)], pa.int64()), pa.array([piece], pa.int32()), pa.array([pieces], pa.int32()),
                 pa.array([docs], pa.list_(pa.int64())), pa.array([lens], pa.list_(pa.int64())),
                 pa.array([data], pa.binary()), pa.array([marks], pa.list_(pa.int32()))],
                ["file", "block", "first", "n_ids", "piece", "pieces", "doc_ids", "doc_lens", "bits", "marks"])
            block, first = block + 1, first + len(values)
            docs, lens, parts, held = [], [], [], 0
            return out

        for batch in batches:
            for doc, data in zip(batch.column("doc_id").to_pylist(), raw_texts(batch.column("ids"))):
                values = np.frombuffer(data, "<u2")
                if held and held + len(values) > block_ids:
                    yield flush(0, 1)
                for piece, at in enumerate(range(0, len(values), block_ids)):
                    part = values[at: at + block_ids]
                    docs.append(doc), lens.append(len(part)), parts.append(part)
                    held += len(part)
                    if len(values) > block_ids:               # a document of several blocks has them to itself
                        yield flush(piece, -(-len(values) // block_ids))
        if held:
            yield flush(0, 1)
    return pack


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, limit: int = LIMIT,
          block_ids: int = BLOCK_IDS) -> None:
    """Encode ``docs`` (doc_id, text) to a folder of the format above, in ascending doc_id order."""
    spark = docs.sparkSession
    plain = new_path(spark, "ids")
    tokens(docs, tokenizer_path, end_id).write.option("compression", "zstd").parquet(plain)
    ids = spark.read.parquet(plain)
    book = codebook(ids, limit)
    spark.createDataFrame([(int(i), int(b)) for i, b in zip(book.ids, book.bits)], "id long, bits int").coalesce(
        1).write.parquet(f"{path}/lengths")
    order = ["doc_id", "crc", "n_tokens"]
    # a plain range over the id; its ties are told apart by the ids' crc
    files = ids.repartitionByRange(*order).sortWithinPartitions(*order)
    if not len(book.ids):
        files = ids.limit(0)
    files.select("doc_id", "ids").mapInArrow(tidied(_packer(book.ids, book.bits, block_ids)), _BLOCK).write.option(
        "compression", "zstd").parquet(f"{path}/blocks")
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    blocks.groupBy("file").agg(F.sum("n_ids").alias("n_ids")).coalesce(1).write.parquet(f"{path}/files")


# -- reading ----------------------------------------------------------------------------

_PIECE = "file int, block long, doc_no int, piece int, doc_id long, local long, n long, crc long, ids binary"


def _reader(ids: np.ndarray, bits: np.ndarray, with_ids: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(ids, bits)
        for whole in batches:
            for batch in slices(whole, 16):
                rows = batch.to_pylist()
                found = book.unpack([(r["bits"], np.array(r["marks"], np.int64), r["n_ids"]) for r in rows])
                out = {k: [] for k in ("file", "block", "doc_no", "piece", "doc_id", "local", "n", "crc", "ids")}
                for r, values in zip(rows, found):
                    at = 0
                    for no, (doc, n) in enumerate(zip(r["doc_ids"], r["doc_lens"])):
                        data = values[at: at + n].astype("<u4").tobytes()
                        for k, v in zip(out, (r["file"], r["block"], no, r["piece"], doc, r["first"] + at, n,
                                              zlib.crc32(data), data if with_ids else None)):
                            out[k].append(v)
                        at += n
                yield pa.RecordBatch.from_pydict(out, pa.schema([
                    ("file", pa.int32()), ("block", pa.int64()), ("doc_no", pa.int32()), ("piece", pa.int32()),
                    ("doc_id", pa.int64()), ("local", pa.int64()), ("n", pa.int64()), ("crc", pa.int64()),
                    ("ids", pa.binary())]))
    return read


def crc32_joined(first: int, second: int, second_bytes: int) -> int:
    """crc32 of two byte strings one after the other, from their crc32 values.

    Appending a zero byte is a linear map over the 32 bits of the value; it is
    applied ``second_bytes`` times by squaring.
    """
    def times(matrix: list[int], vector: int) -> int:
        out, k = 0, 0
        while vector:
            if vector & 1:
                out ^= matrix[k]
            vector, k = vector >> 1, k + 1
        return out

    bit = [0xEDB88320] + [1 << k for k in range(31)]              # one zero bit appended
    power = bit
    for _ in range(3):                                            # one zero byte
        power = [times(power, c) for c in power]
    while second_bytes:
        if second_bytes & 1:
            first = times(power, first)
        power, second_bytes = [times(power, c) for c in power], second_bytes >> 1
    return first ^ second


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start block, doc_id, local, pieces sorted by number) -> length and crc of the whole."""
    for batch in batches:
        out = {"file": [], "doc_id": [], "local": [], "n": [], "crc": []}
        for r in batch.to_pylist():
            n, crc = 0, 0
            for p in r["pieces"]:
                n, crc = n + p["n"], crc32_joined(crc, p["crc"], 4 * p["n"])
            for k, v in zip(out, (r["file"], r["doc_id"], r["local"], n, crc)):
                out[k].append(v)
        yield pa.RecordBatch.from_pydict(out, pa.schema([
            ("file", pa.int32()), ("doc_id", pa.int64()), ("local", pa.int64()), ("n", pa.int64()),
            ("crc", pa.int64())]))


def read_book(spark: SparkSession, path: str) -> Codebook:
    rows = sorted(spark.read.parquet(f"{path}/lengths").select("id", "bits").collect())
    return Codebook(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64))


def read_pieces(spark: SparkSession, path: str, where: str = "true", with_ids: bool = True) -> DataFrame:
    """Every document (one of several blocks as pieces) decoded from the files."""
    book = read_book(spark, path)
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks").where(where)
    return blocks.mapInArrow(tidied(_reader(book.ids, book.bits, with_ids)), _PIECE)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    # a row for each file: their totals add up to where each begins
    order = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = spark.read.parquet(f"{path}/files").select(
        F.col("file").alias("f"), F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("base"))
    whole = read_pieces(spark, path, "pieces = 1", False).select("file", "doc_id", "local", "n", "crc")
    joined = (read_pieces(spark, path, "pieces > 1", False)
              .groupBy("file", (F.col("block") - F.col("piece")).alias("at"), "doc_id")
              .agg(F.min("local").alias("local"),
                   F.sort_array(F.collect_list(F.struct("piece", "n", "crc"))).alias("pieces"))
              .select("file", "doc_id", "local", "pieces")
              .mapInArrow(tidied(_join_pieces), "file int, doc_id long, local long, n long, crc long"))
    return whole.unionByName(joined).join(files, F.col("file") == F.col("f")).select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), F.col("n").alias("n_tokens"),
        F.col("crc").alias("ids_crc32"))
