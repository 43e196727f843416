"""Alignment of two tokenizers' tokens over the same bytes, by merge-path partitioning.

A text's tokens under tokenizer A (byte-level BPE, of a space and the text) and under
tokenizer B (SentencePiece, which adds that space) cover the same bytes, so each tokenizer
is a rising list of byte ends.  The ends of all texts of a batch, moved one behind the
other, are two sorted lists.  Their merge is cut where the diagonals of every ``PIECE``-th
merged item cross the merge path; binary searches over all diagonals at once find the
places, so each piece holds as many items as any other, whatever the texts' lengths, and
is merged on its own.  A piece emits an overlap (a token of A, a token of B, where their
common bytes end) at each of its distinct ends.  An end that both lists hold closes a
group; the two items of such an end may lie in two pieces, so each piece looks at the last
end before it and the first one after it, and the groups come out whole.

Two tokens that end together are a link.  What pairs of ids are linked how often is counted
over the whole corpus, and each document is told how many of its links are the most
frequent one of their id in B, and the sum of their counts.

Both encoders work on stretches of text that start at a space behind something else than
white space: neither tokenizer joins across such a place (checked for B's pieces when the
model is loaded).  Distinct stretches are remembered.

Defined cases: null and empty texts, and texts whose tokens' bytes are not the space and
the text (the space mark of B within a text), have no tokens: counts are 0 and ``groups``
is empty; special tokens' names within texts are plain text; rows that repeat are aligned
and counted each; a null doc_id is passed on; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import Remembered, slices, stash

MARK = "▁"
PIECE = 1024                    # merged items of one piece
ROWS = 128                      # documents whose ends are merged together, fewer if they are long
CHARS = 1 << 18                 # characters of such documents, unless one text alone has more
BROADCAST_PAIRS = 2_000_000     # linked pairs that are sent to the tasks at 17 bytes each; beyond, a shuffle join
OF_B, WRONG = 1 << 24, 1 << 25  # marks of remembered ids
_WRONG = np.array([WRONG], "<i4").tobytes()
_BEHIND_SPACE = re.compile(r"\s ")
_STRETCH = re.compile(r"\s*\S+(?:[^\S ]\s*\S+)*(?:[^\S ]\s*)?|\s+")
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""   # fixed by the tokenizer


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Encoders:
    """Both tokenizers, the bytes of their tokens, and the stretches of text encoded so far."""

    def __init__(self, a_path: str, b_path: str, limit: int = 150_000):
        import sentencepiece
        import tiktoken
        with open(a_path, encoding="utf-8") as f:
            model = json.load(f)
        letters, special = _byte_letters(), {t["content"] for t in model["added_tokens"] if t["special"]}
        self.a_bytes = {i: t.encode() if t in special else bytes(letters[c] for c in t)
                        for t, i in model["model"]["vocab"].items()}
        ranks = {self.a_bytes[i]: i for t, i in model["model"]["vocab"].items() if t not in special}
        if [model["model"]["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["model"]["merges"]] != \
                sorted(i for b, i in ranks.items() if len(b) > 1):
            raise ValueError("the ids of A's merged tokens must rise in the order of its merges")
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece of B holds a space behind another character")
        self.b_bytes = {i: b"" if self.b.is_control(i) else bytes([int(p[1:-1], 16)]) if self.b.is_byte(i)
                        else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)}
        self.a_sizes, self.b_sizes = (np.array([len(x.get(i, b"")) for i in range(max(x) + 1)], np.int64)
                                      for x in (self.a_bytes, self.b_bytes))
        # a token's id with what follows it: the next id of its side, or the other side's or the next group's ids
        texts = [f"{i}{end}".encode() for n, ends in ((len(self.a_sizes), ",|"), (len(self.b_sizes), ",;"))
                 for end in ends for i in range(n)]
        self.shown = np.empty(len(texts), object)
        self.shown[:] = texts
        self.known = Remembered(limit)

    def learn(self, stretches: list[str]) -> None:
        """Remember the ids of stretches, each with a space before it: A's, then B's with ``OF_B`` added.

        Where a side's bytes are not the stretch, ``WRONG`` stands in their place.
        """
        # a stretch that ends in white space ends its text: what follows would change it
        last = [s for s in stretches if not s or s[-1].isspace()]
        inner = [s for s in stretches if s and not s[-1].isspace()]
        for part in [*([s] for s in last), *(inner[k: k + 5000] for k in range(0, len(inner), 5000))]:
            # one behind the other they are a text that falls apart where they start
            text = " " + " ".join(part)
            a = np.array(self.a.encode_ordinary(text), np.int64)
            stops, ends = np.cumsum([len(s.encode()) + 1 for s in part]), np.cumsum(self.a_sizes[a])
            a_upto = np.searchsorted(ends, stops) + 1
            if not np.array_equal(ends[a_upto - 1], stops):
                raise ValueError("A joins across the start of a stretch")
            # B adds the space itself, but none to an empty text: there the space is read off behind a byte piece
            b = self.b.encode(part, num_threads=1) if part[0] else [self.b.encode("\x00 ")[2:]]
            b_upto = np.cumsum(list(map(len, b)))
            b = np.fromiter(chain.from_iterable(b), np.int64)
            plain, said = text.encode(), list(map(self.b_bytes.__getitem__, b.tolist()))
            wrong = []
            if b"".join(said) != plain or not np.array_equal(np.cumsum(self.b_sizes[b])[b_upto - 1], stops):
                starts = [0, *b_upto.tolist()]
                wrong = [s for s, x, y in zip(part, starts, starts[1:]) if b"".join(said[x:y]) != b" " + s.encode()]
            flat = np.empty(len(a) + len(b), "<i4")
            flat[np.arange(len(a)) + np.repeat(np.append(0, b_upto[:-1]), np.diff(a_upto, prepend=0))] = a
            flat[np.arange(len(b)) + np.repeat(a_upto, np.diff(b_upto, prepend=0))] = b + OF_B
            flat, at = flat.tobytes(), [0, *((a_upto + b_upto) * 4).tolist()]
            self.known.update(zip(part, [flat[x:y] for x, y in zip(at, at[1:])]))
            self.known.update(dict.fromkeys(wrong, _WRONG))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids under A and B of a space and each text, one text behind the other, and how many each has.

        A text has none where their bytes are something else.
        """
        known = self.known
        parts = [[] if not t else t.split(" ") if t[0] != " " and not _BEHIND_SPACE.search(t) else
                 [s[1:] for s in _STRETCH.findall(" " + t)] for t in texts]
        known.make_room()
        self.learn(list(set().union(*parts).difference(known).difference(known.older)))
        said = [b"".join(map(known.__getitem__, p)) for p in parts]
        ids = np.frombuffer(b"".join(said), "<i4")
        row = np.repeat(np.arange(len(said)), [len(x) // 4 for x in said])
        wrong = np.bincount(row[ids == WRONG], minlength=len(said)) > 0
        if wrong.any():
            ids, row = ids[~wrong[row]], row[~wrong[row]]
        of_a = ids < OF_B
        return ids[of_a], ids[~of_a] - OF_B, *(np.bincount(row[k], minlength=len(said)) for k in (of_a, ~of_a))


@lru_cache(1)
def encoders(a_path: str, b_path: str) -> Encoders:
    """Both tokenizers, once for each Python worker."""
    return Encoders(a_path, b_path)


# -- the merge path ---------------------------------------------------------------------------

def crossings(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many items of ``a`` are among the first d merged items, for each d; of equal ones a's come first."""
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        at, mid = np.flatnonzero(open_), (low[open_] + high[open_]) // 2
        taken = a[mid] <= b[diagonals[at] - 1 - mid]
        low[at[taken]], high[at[~taken]] = mid[taken] + 1, mid[~taken]
    return low


def overlaps(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(token of a, token of b, end, both end there) of every overlap of two rising lists of ends, in order.

    Both lists must have the same last end.
    """
    total = len(a) + len(b)
    if not total:
        return *(np.zeros(0, np.int64),) * 3, np.zeros(0, bool)
    diagonals = np.append(np.arange(0, total, piece), total)
    i = crossings(a, b, diagonals)
    j, n = diagonals - i, len(diagonals) - 1
    # one row for each piece: its run of a, then its run of b, and at the very end what fills up the last row
    kind = np.int32 if a[-1] < 1 << 29 else np.int64
    items = np.full((n, piece), np.iinfo(kind).max, kind)
    at_a = np.arange(len(a)) + np.repeat(np.arange(n) * piece - i[:-1], np.diff(i))
    at_b = np.arange(len(b)) + np.repeat(np.arange(n) * piece + np.diff(i) - j[:-1], np.diff(j))
    items.reshape(-1)[at_a], items.reshape(-1)[at_b] = a * 2, b * 2 + 1
    items.sort(axis=1)
    # tokens that ended before each item: those before its piece and those before it in the piece
    side = items & 1
    b_done = np.cumsum(side, axis=1, dtype=kind) - side
    a_done = np.arange(piece, dtype=kind) - b_done
    a_done += i[:-1, None].astype(kind)
    b_done += j[:-1, None].astype(kind)
    # the stitch: neighbours are compared across the pieces' edges too
    items, a_done, b_done = (x.reshape(-1)[:total] for x in (items, a_done, b_done))
    same = items[1:] == items[:-1] | 1
    emits = np.flatnonzero(np.append(True, ~same))
    return a_done[emits], b_done[emits], items[emits] >> 1, np.append(same, False)[emits]


def _grouped(model: Encoders, a_ids: np.ndarray, b_ids: np.ndarray, a_cut: np.ndarray, b_cut: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
    """All ids as text, group after group, and how many precede each group's end; the cuts are counts at each group's end."""
    a_before, b_before = np.append(0, a_cut), np.append(0, b_cut)
    na, nb = np.diff(a_before), np.diff(b_before)
    shown = np.empty(len(a_ids) + len(b_ids), np.int64)
    a_code, b_code = a_ids.astype(np.int64), b_ids + np.int64(2 * len(model.a_sizes))
    a_code[a_cut - 1] += len(model.a_sizes)
    b_code[b_cut - 1] += len(model.b_sizes)
    shown[np.arange(len(a_ids)) + np.repeat(b_before[:-1], na)] = a_code
    shown[np.arange(len(b_ids)) + np.repeat(a_cut, nb)] = b_code
    return model.shown[shown], a_cut + b_cut


ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_overlaps long, groups string, "
           "link_a array<int>, link_b array<int>, link_n array<int>")
SPANS = ", over_a array<int>, over_b array<int>, over_end array<long>"


def _lists(values: np.ndarray, counts: np.ndarray, kind=np.int32) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(values.astype(kind)))


def _aligner(a_path: str, b_path: str, spans: bool, piece: int):
    def aligned(model: Encoders, part: pa.RecordBatch) -> pa.RecordBatch:
        rows = part.num_rows
        a_ids, b_ids, n_a, n_b = model.encode(part.column("text").to_pylist())
        a_ends = np.cumsum(model.a_sizes[a_ids])
        over_a, over_b, ends, both = overlaps(a_ends, np.cumsum(model.b_sizes[b_ids]), piece)
        # the row each overlap is of: by its token in A
        first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        row = np.searchsorted(np.cumsum(n_a), over_a, side="right")
        link_a, link_b, link_row = over_a[both], over_b[both], row[both]
        n_over, n_links = np.bincount(row, minlength=rows), np.bincount(link_row, minlength=rows)
        shown, cut = _grouped(model, a_ids, b_ids, link_a + 1, link_b + 1)
        parts = shown.tolist()
        upto = np.cumsum(n_a + n_b)
        texts = [b"".join(parts[x:y])[:-1] for x, y in zip((upto - n_a - n_b).tolist(), upto.tolist())]
        # a row's distinct pairs and how often each is linked in it
        pair = (link_row << 48) + (a_ids[link_a].astype(np.int64) << 24) + b_ids[link_b]
        pair.sort()
        new = np.flatnonzero(np.diff(pair, prepend=-1))
        times, pair = np.diff(np.append(new, len(pair))), pair[new]
        of, pair = pair >> 48, pair & 0xFFFFFFFFFFFF
        distinct = np.bincount(of, minlength=rows)
        out = [part.column("doc_id"), pa.array(n_a), pa.array(n_b), pa.array(n_links.astype(np.int64)),
               pa.array(n_over.astype(np.int64)), pa.array(texts, pa.binary()).cast(pa.string()),
               _lists(pair >> 24, distinct), _lists(pair & 0xFFFFFF, distinct), _lists(times, distinct)]
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_overlaps", "groups", "link_a", "link_b", "link_n"]
        if spans:
            first_end = np.append(0, a_ends)[first_a]
            out += [_lists(over_a - first_a[row], n_over), _lists(over_b - first_b[row], n_over),
                    _lists(ends - first_end[row], n_over, np.int64)]
            names += ["over_a", "over_b", "over_end"]
        return pa.RecordBatch.from_arrays(out, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoders(a_path, b_path)
        for whole in batches:
            for batch in slices(whole, ROWS):
                sizes = [len(x.as_py() or "") for x in batch.column("text")]
                start = held = 0
                for k, n in enumerate(sizes):                    # long texts: fewer rows at once
                    if held and held + n > CHARS:
                        yield aligned(model, batch.slice(start, k - start))
                        start, held = k, 0
                    held += n
                yield aligned(model, batch.slice(start))
    return run


def aligned(docs: DataFrame, a_path: str, b_path: str, spans: bool = False, piece: int = PIECE) -> DataFrame:
    """Of each row of ``docs`` (doc_id, text): numbers of tokens, groups and overlaps, the groups as text
    (``a1,a2|b1;a3|b2,b3``), and its distinct linked id pairs with how often each is linked.

    With ``spans`` also every overlap: the numbers of both tokens in the document, and the byte
    (the added space counts) at which their common bytes end.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _aligner(a_path, b_path, spans, piece), ALIGNED + (SPANS if spans else ""))


# -- counts over the corpus ---------------------------------------------------------------------

def _summed(limit: int = 500_000):
    """Adds up the pairs of many rows in a task before they are shuffled."""
    def emit(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        pair, where = np.unique(np.concatenate(keys), return_inverse=True)
        return pair, np.bincount(where, weights=np.concatenate(times), minlength=len(pair)).astype(np.int64)

    def out(pair: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array((pair >> 32).astype(np.int32)),
                                           pa.array((pair & 0xFFFFFFFF).astype(np.int32)), pa.array(n)], ["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times, held, kept = [], [], 0, 0
        for batch in batches:
            a, b, n = (batch.column(c).flatten().to_numpy() for c in ("link_a", "link_b", "link_n"))
            keys.append(a.astype(np.int64) << 32 | b)
            times.append(n.astype(np.int64))
            held += len(a)
            if held > kept + limit:
                pair, n = emit(keys, times)
                if len(pair) > 2 * limit:
                    yield out(pair, n)
                    pair, n = pair[:0], n[:0]
                keys, times, held = [pair], [n], len(pair)
                kept = held
        if held:
            yield out(*emit(keys, times))
    return run


def pair_counts(found: DataFrame) -> DataFrame:
    """(a, b, n, best): how many links of all rows hold each id pair, and whether b has none more frequent."""
    counts = found.select("link_a", "link_b", "link_n").mapInArrow(_summed(), "a int, b int, n long").groupBy(
        "a", "b").agg(F.sum("n").alias("n"))
    counts = stash(counts, "alignment-counts", release=False)
    top = counts.groupBy("b").agg(F.max("n").alias("top"))       # at most one row for each id of B
    return stash(counts.join(top, "b").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best")),
                 "alignment-pairs", release=False)


def _teller(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, count, best = sent.value
        for batch in batches:
            a, b, n = (batch.column(c).flatten().to_numpy() for c in ("link_a", "link_b", "link_n"))
            at = np.searchsorted(pair, a.astype(np.int64) << 32 | b)
            rows = np.repeat(np.arange(batch.num_rows), np.diff(batch.column("link_a").offsets.to_numpy()))
            n_best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(n_best, rows, n * best[at])
            np.add.at(total, rows, n * count[at])
            kept = [batch.column(k) for k in range(batch.num_columns - 3)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n_best), pa.array(total)],
                                             [*batch.schema.names[:-3], "n_best", "count_sum"])
    return run


def with_counts(found: DataFrame, pairs: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``found`` with n_best and count_sum in place of its pairs.

    The table of pairs is sent to the tasks while it is small; its size is bounded by both
    vocabularies, not by the corpus, but may exceed what a task should hold.  Then each row's
    pairs meet their counts in a shuffle join; ``row`` must tell rows apart.
    """
    links = ("link_a", "link_b", "link_n")
    other = [c for c in found.columns if c not in links]
    if pairs.limit(broadcast_pairs + 1).count() <= broadcast_pairs:
        held = pairs.toArrow().combine_chunks()
        a, b, n, best = (held.column(c).to_numpy() for c in ("a", "b", "n", "best"))
        pair = a.astype(np.int64) << 32 | b
        order = np.argsort(pair)
        sent = found.sparkSession.sparkContext.broadcast((pair[order], n[order], best[order]))
        return found.select(*other, *links).mapInArrow(
            _teller(sent), found.select(*other).withColumns({"n_best": F.lit(0).cast("long"),
                                                             "count_sum": F.lit(0).cast("long")}).schema)
    each = found.select("row", F.explode(F.arrays_zip(*links)).alias("l")).select(
        "row", F.col("l.link_a").alias("a"), F.col("l.link_b").alias("b"), F.col("l.link_n").alias("times"))
    told = each.join(pairs, ["a", "b"]).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("long").alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    return found.select(*other).join(told, "row", "left").fillna(0, ["n_best", "count_sum"])


def digests(docs: DataFrame, a_path: str, b_path: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Of each row: n_a, n_b, n_groups, n_links, n_best, count_sum, the groups' sha256, n_overlaps."""
    found = aligned(docs, a_path, b_path).withColumn(
        "groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))).drop("groups")
    found = stash(found.withColumn("row", F.monotonically_increasing_id()), "alignment", release=False)
    return with_counts(found, pair_counts(found), broadcast_pairs).select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256",
        "n_overlaps")
