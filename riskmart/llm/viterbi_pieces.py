"""SentencePiece encoding and decoding in batches of words in numpy: merges for BPE models, Viterbi for others.

A text gets one leading space, spaces become the space mark, and the result falls
apart at every space that follows another character, since no piece holds such a place
(checked when the model is loaded).  Distinct words of equal length form a matrix of
characters; hashes of its substrings probe the sorted hashes of the pieces.

Of a model of type BPE the scores are ranks of merges, whose sum says nothing.  There,
all words of a matrix take one merge a step, each its own best: the two neighbours that
form the piece of the greatest score, the leftmost of equals, until none form a piece.
Words longer than ``LONG`` characters do the same with a heap.  The ids are those of the
library's ``encode``.

Of other models a text becomes the pieces whose scores add up to the most: the matrix
advances one character a step, and the maximum over the lengths of the last piece gives
score and backpointer of all words at once.  Of equal sums the longer last piece wins.

A character without a piece becomes its UTF-8 bytes' pieces.

Defined cases: a null text is empty, an empty text has no ids; the space mark
itself counts as a space, so it decodes to one; other texts decode to themselves;
rows that repeat are encoded each; an empty table gives an empty result; null ids
are passed on; the other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import Remembered, mix, raw_texts, slices, whole_text

MARK = "▁"
UNKNOWN_PENALTY = 10.0          # an unknown character scores this much below the worst piece
CELLS = 400_000                 # characters of one matrix of words
BPE = 2                         # TrainerSpec.ModelType
LONG = 200                      # characters from which a word is merged alone
_WORD = re.compile(rb" +[^ ]*")


def _step(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    return mix(h * np.uint64(0x2545F4914F6CDD1D) + c.astype(np.uint64) + np.uint64(1))


class Pieces:
    """A model's pieces by the hash of their characters, and the words encoded so far."""

    def __init__(self, path: str, limit: int = 300_000):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        from sentencepiece import sentencepiece_model_pb2
        spec = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto())
        self.bpe = spec.trainer_spec.model_type == BPE
        if self.bpe and any(p.type in (p.USER_DEFINED, p.UNUSED) for p in spec.pieces):
            raise ValueError("user-defined and unused pieces of a BPE model are not handled")
        texts = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.byte = np.zeros(256, np.uint32)
        self.plain = [b""] * len(texts)                       # what an id decodes to
        normal = []
        for i, text in enumerate(texts):
            if model.is_byte(i):
                self.byte[int(text[3:5], 16)] = i
                self.plain[i] = bytes([int(text[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if re.search(f"[^{MARK}]{MARK}", text):
                    raise ValueError(f"piece {text!r} spans a word boundary")
                normal.append(i)
                self.plain[i] = text.replace(MARK, " ").encode()
        self.scores = {texts[i]: float(model.get_score(i)) for i in normal}
        self.numbers = {texts[i]: i for i in normal}
        self.longest = max(map(len, self.scores))
        self.unknown = min(self.scores.values()) - UNKNOWN_PENALTY
        keys = self._keys([texts[i] for i in normal])
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(normal, np.int64)[order]
        self.values = np.array([self.scores[texts[i]] for i in normal])[order]
        self.filter = np.zeros(1 << 20, bool)                 # low bits of the keys: most substrings end here
        self.filter[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.known = Remembered(limit)

    @staticmethod
    def _keys(texts: list[str]) -> np.ndarray:
        out, sizes = np.zeros(len(texts), np.uint64), np.array([len(t) for t in texts])
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            chars = np.array([[ord(c) for c in texts[i]] for i in at], np.uint64)
            h = np.zeros(len(at), np.uint64)
            for k in range(size):
                h = _step(h, chars[:, k])
            out[at] = h
        return out

    def _probe(self, h: np.ndarray) -> np.ndarray:
        """Position among the sorted keys, or -1."""
        out = np.full(h.shape, -1, np.int64)
        maybe = np.nonzero(self.filter[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
        wanted = h[maybe]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        out[maybe] = np.where(self.keys[at] == wanted, at, -1)
        return out

    def _substrings(self, chars: np.ndarray) -> np.ndarray:
        """[:, j, l - 1]: position of the piece of l characters that ends before j, or -1."""
        words, length = chars.shape
        most = min(self.longest, length)
        piece = np.full((words, length + 1, most), -1, np.int64)
        h = np.zeros((words, length), np.uint64)
        for l in range(1, most + 1):
            h = _step(h[:, : length - l + 1], chars[:, l - 1:])
            piece[:, l:, l - 1] = self._probe(h)
        return piece

    def merged(self, chars: np.ndarray) -> list[bytes]:
        """Little-endian ids of words of one length by merges; ``chars``: a row of code points for each word."""
        words, length = chars.shape
        piece = self._substrings(chars)
        most = piece.shape[2]
        # of the part that begins at a place: its end, and where the part before begins
        end = np.tile(np.arange(1, length + 2), (words, 1))
        before = np.tile(np.arange(-1, length), (words, 1))
        begins = np.ones((words, length + 1), bool)

        def score(row: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
            size = stop - begin
            found = np.where((size <= most) & (stop <= length),
                             piece[row, np.minimum(stop, length), np.minimum(size, most) - 1], -1)
            return np.where(found >= 0, self.values[found], -np.inf)

        # what the part that begins at a place and the next one score together
        joint = np.full((words, length), -np.inf)
        if most > 1:
            joint[:, :-1] = np.where(piece[:, 2:, 1] >= 0, self.values[piece[:, 2:, 1]], -np.inf)
        row = np.arange(words)
        while len(row):
            at = joint[row].argmax(1)                         # the leftmost of equals
            left = joint[row, at] > -np.inf
            row, at = row[left], at[left]
            gone = end[row, at]
            stop = end[row, gone]
            end[row, at], before[row, stop] = stop, at
            begins[row, gone] = False
            joint[row, gone] = -np.inf
            joint[row, at] = score(row, at, np.where(stop < length, end[row, stop], length + 1))
            first = before[row, at] >= 0
            r, a = row[first], at[first]
            joint[r, before[r, a]] = score(r, before[r, a], end[r, a])
        rows, starts = np.nonzero(begins[:, :-1])
        ends = end[rows, starts]
        return self._spelled(chars, rows, piece[rows, ends, ends - starts - 1], ends)

    def merged_long(self, points: np.ndarray) -> bytes:
        """Little-endian ids of one word by merges, best pair first from a heap."""
        text, n = "".join(map(chr, points.tolist())), len(points)
        end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap: list[tuple[float, int, int, int]] = []

        def offer(begin: int, middle: int, stop: int) -> None:
            if stop - begin <= self.longest and (found := self.scores.get(text[begin:stop])) is not None:
                heapq.heappush(heap, (-found, begin, middle, stop))

        for k in range(n - 1):
            offer(k, k + 1, k + 2)
        while heap:
            _, begin, middle, stop = heapq.heappop(heap)
            if not alive[begin] or end[begin] != middle or end[middle] != stop:
                continue                                      # a part of it was merged otherwise
            end[begin], alive[middle] = stop, False
            if stop < n:
                before[stop] = begin
                offer(begin, stop, end[stop])
            if before[begin] >= 0:
                offer(before[begin], begin, stop)
        ids, at = [], 0
        while at < n:
            found = self.numbers.get(text[at:end[at]])
            ids.extend([found] if found is not None else self.byte[list(text[at].encode("utf-8", "replace"))].tolist())
            at = end[at]
        return np.array(ids, "<u4").tobytes()

    def viterbi(self, chars: np.ndarray) -> list[bytes]:
        """Little-endian ids of words of one length by sums; ``chars``: a row of code points for each word."""
        words, length = chars.shape
        piece = self._substrings(chars)
        most = piece.shape[2]
        gain = np.where(piece >= 0, self.values[piece], -np.inf)
        gain[:, 1:, 0] = np.where(piece[:, 1:, 0] >= 0, gain[:, 1:, 0], self.unknown)
        best = np.full((words, length + most + 1), -np.inf)   # shifted by most: best[:, most + j]
        best[:, most] = 0
        back = np.zeros((words, length + 1), np.int64)
        for j in range(1, length + 1):
            # longest first, so that argmax takes the longer of equals
            total = best[:, j: j + most] + gain[:, j, ::-1]
            pick = total.argmax(1)
            best[:, most + j] = total[np.arange(words), pick]
            back[:, j] = most - pick
        at, row = np.full(words, length), np.arange(words)
        steps = []
        while len(row):
            size = back[row, at]
            steps.append((row, piece[row, at, size - 1], at))
            at = at - size
            row, at = row[at > 0], at[at > 0]
        rows, found, ends = (np.concatenate(x) for x in zip(*steps))
        order = np.lexsort((ends, rows))
        return self._spelled(chars, rows[order], found[order], ends[order])

    def _spelled(self, chars: np.ndarray, rows: np.ndarray, found: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Little-endian ids of each row of ``chars`` from its parts in order: their pieces (or -1) and ends."""
        words = len(chars)
        # characters without a piece are spelled in bytes
        spelled = {k: self.byte[list(chr(chars[rows[k], ends[k] - 1]).encode("utf-8", "replace"))]
                   for k in np.flatnonzero(found < 0).tolist()}
        count = np.ones(len(rows), np.int64)
        for k, x in spelled.items():
            count[k] = len(x)
        ids, begin = np.repeat(self.ids[found], count), np.cumsum(count) - count
        for k, x in spelled.items():
            ids[begin[k]: begin[k] + len(x)] = x
        data = ids.astype("<u4").tobytes()
        cuts = 4 * np.concatenate([[0], np.cumsum(np.bincount(rows, weights=count, minlength=words))]).astype(np.int64)
        return [data[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def _learn(self, words: list[bytes]) -> None:
        by_length = defaultdict(list)
        for w in words:
            points = np.frombuffer(w.decode("utf-8", "replace").replace(" ", MARK).encode("utf-32-le"), "<u4")
            by_length[len(points)].append((w, points))
        encode = self.merged if self.bpe else self.viterbi
        for length, group in by_length.items():
            if self.bpe and length > LONG:
                for w, points in group:
                    self.known[w] = self.merged_long(points)
                continue
            rows = max(1, CELLS // (length * min(length, self.longest)))
            for at in range(0, len(group), rows):
                part = group[at: at + rows]
                for (w, _), ids in zip(part, encode(np.stack([p for _, p in part]))):
                    self.known[w] = ids

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        mark = MARK.encode()
        words = [_WORD.findall(b" " + t.replace(mark, b" ")) if t else [] for t in texts]
        known = self.known
        known.make_room()
        self._learn(known.unknown(words))
        return [b"".join(map(known.__getitem__, ws)) for ws in words]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.plain.__getitem__, np.frombuffer(ids, "<u4").tolist()))[1:]


@lru_cache(1)
def pieces(path: str) -> Pieces:
    """One model for each Python worker."""
    return Pieces(path)


def _encoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for whole in batches:
            for batch in slices(whole, 256):
                ids = model.encode(list(raw_texts(batch.column("text"))))
                sizes = np.cumsum([0] + [len(x) // 4 for x in ids]).astype(np.int32)
                values = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(np.diff(sizes).astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(sizes), pa.array(values))],
                    ["doc_id", "n_tokens", "ids"])
    return run


def encoded(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of each row of ``docs`` (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(
        _encoder(model_path), "doc_id long, n_tokens long, ids array<int>")


def _decoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for whole in batches:
            for batch in slices(whole, 256):
                texts = [model.decode(np.asarray(x.values, np.uint32).astype("<u4").tobytes() if x.is_valid else b"")
                         for x in batch.column("ids")]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string())],
                                                 ["doc_id", "text"])
    return run


def decoded(ids: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) of each row of ``ids`` (doc_id, ids)."""
    return ids.select("doc_id", "ids").mapInArrow(_decoder(model_path), "doc_id long, text string")


def _checker(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, mark = pieces(path), MARK.encode()
        for whole in batches:
            for batch in slices(whole, 256):
                texts = list(raw_texts(batch.column("text")))
                ids = model.encode(texts)
                back = [model.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in back], pa.string()),
                     pa.array([b == t.replace(mark, b" ") for b, t in zip(back, texts)], pa.bool_())],
                    ["doc_id", "n_tokens", "ids_crc32", "decoded_sha256", "round_trip"])
    return run


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """Of each row: number and crc32 of its ids, sha256 of what they decode to, and whether that is the text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(
        _checker(model_path),
        "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string, round_trip boolean")
