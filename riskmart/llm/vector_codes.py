"""Compression of vectors to codes of one byte a part, by integer Walsh-Hadamard transforms.

Components become integers, floor(4096 x); a vector is cut into 8 equal parts and each part
is replaced by the number of the nearest of its position's 16 entries.  Parts and entries
are filled up with zeros to a power of two and transformed by integer additions and
subtractions only.  The transform keeps distances up to that power of two, so the squared
differences of the transformed ones, added up in the order of sequency (slow waves first),
are the scaled distance; an entry drops out as soon as its sum exceeds the whole distance of
the entry that looked best after the first waves.  No floating point is involved, so codes,
entries and errors are exact, in any order of rows and partitions.

Each round is one pass over the vectors: tasks add up the parts of each entry, the sums
(positions times entries, whatever the number of rows) are added by a grouping, and the
driver divides them.  Sums travel in limbs of 32 bits, so no size of component can overflow
them; components too large for 64-bit distances are worked as Python integers.

Defined cases: a row whose vector is null or has a null, NaN or infinite component is
dropped; a null vec_id is kept and comes last; of rows with one vec_id the smaller vector
comes first; vectors of other lengths are filled up with zeros to the longest one, and that
to a multiple of 8; with fewer than 16 rows there are as many entries; equal nearest entries:
the first; a null label is a label; an error beyond 64 bits is given as the largest long; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import stash

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
ROWS = 4096                     # vectors of one block in a task
FIRST_WAVES = 2                 # coefficients after which the first guess is made
BROADCAST_LABELS = 100_000      # labels whose sums are sent to the tasks; beyond, a shuffle join
_LARGEST = (1 << 63) - 1
_LIMB = 32


# -- integers -----------------------------------------------------------------------------------

def integers(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """floor(SCALE x) of float64 vectors, filled up to ``width``; Python integers where 64 bits might not do."""
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    if np.abs(out).max(initial=0) * SCALE < (1 << 29) / _padded(width // PARTS):
        return np.floor(out * SCALE).astype(np.int64)
    exact = np.empty(out.shape, object)
    for at, x in np.ndenumerate(out):
        top, bottom = float(x).as_integer_ratio()
        exact[at] = top * SCALE // bottom
    return exact


def _padded(n: int) -> int:
    return 1 << max(n - 1, 0).bit_length()


def transformed(parts: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the last axis, filled up with zeros to a power of two, in the order of sequency."""
    n = _padded(parts.shape[-1])
    x = np.zeros((*parts.shape[:-1], n), parts.dtype)
    x[..., :parts.shape[-1]] = parts
    step = 1
    while step < n:
        pairs = x.reshape(*x.shape[:-1], -1, 2, step)
        x = np.stack([pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]], -2).reshape(x.shape)
        step *= 2
    return x[..., sequency_order(n)]


def sequency_order(n: int) -> list[int]:
    """Rows of the plain transform of size ``n`` by how often their wave changes sign."""
    bits = n.bit_length() - 1
    gray = (k ^ k >> 1 for k in range(n))
    return [int(format(g, f"0{bits}b")[::-1], 2) if bits else 0 for g in gray]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest entry for each row of ``parts``; of equal ones the first."""
    if object in (parts.dtype, entries.dtype):           # both as Python integers
        parts, entries = parts.astype(object), entries.astype(object)
    x, e = transformed(parts), transformed(entries)
    n, width = x.shape
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, x.dtype)
    first = min(FIRST_WAVES, width)
    sums = np.zeros((n, len(e)), x.dtype)
    for k in range(first):
        sums += (x[:, k, None] - e[None, :, k]) ** 2
    guess = np.argmin(sums, axis=1)
    bound = ((x - e[guess]) ** 2).sum(axis=1)
    rows, left = np.nonzero(sums <= bound[:, None])
    sums = sums[rows, left]
    for k in range(first, width):
        sums = sums + (x[rows, k] - e[left, k]) ** 2
        stay = sums <= bound[rows]
        rows, left, sums = rows[stay], left[stay], sums[stay]
    # every row's guess is left over; a row's entries stand in rising order, and so does the first of the least
    starts = np.flatnonzero(np.diff(rows, prepend=-1))
    least = np.minimum.reduceat(sums, starts)
    found = np.flatnonzero(sums == np.repeat(least, np.diff(np.append(starts, len(rows)))))
    found = found[np.diff(rows[found], prepend=-1) > 0]
    return left[found], least // width


# -- passes over the rows ---------------------------------------------------------------------------

def _vectors(batch: pa.RecordBatch, width: int) -> Iterator[tuple[slice, np.ndarray]]:
    column = batch.column("embedding")
    for at in range(0, batch.num_rows, ROWS):
        part = column.slice(at, ROWS)
        offsets, values = part.offsets.to_numpy(), part.values.to_numpy(zero_copy_only=False)
        yield slice(at, at + len(part)), integers([values[x:y] for x, y in zip(offsets, offsets[1:])], width)


def _adder(books: np.ndarray, width: int):
    """A task's sums: rows (part, entry, position, limb, value); position -1 counts the parts."""
    size = width // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((PARTS, books.shape[1], size), object)
        counts = np.zeros((PARTS, books.shape[1]), np.int64)
        for batch in batches:
            for _, x in _vectors(batch, width):
                for p in range(PARTS):
                    part = x[:, p * size: (p + 1) * size]
                    code = nearest(part, books[p])[0]
                    counts[p] += np.bincount(code, minlength=books.shape[1])
                    for c in np.unique(code):
                        sums[p, c] += part[code == c].sum(axis=0)
        rows = [(p, c, -1, 0, int(n)) for (p, c), n in np.ndenumerate(counts) if n]
        for (p, c, k), value in np.ndenumerate(sums):
            value, limb = int(value), 0
            while counts[p, c] and value not in (0, -1):
                rows.append((p, c, k, limb, value & (1 << _LIMB) - 1))
                value, limb = value >> _LIMB, limb + 1
            if value == -1:
                rows.append((p, c, k, limb, -1))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], pa.int64() if k == 4 else pa.int32()) for k in range(5)],
            ["part", "entry", "position", "limb", "value"])
    return run


def _coder(books: np.ndarray, width: int):
    size = width // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = [], []
            for _, x in _vectors(batch, width):
                found = [nearest(x[:, p * size: (p + 1) * size], books[p]) for p in range(PARTS)]
                code = np.stack([c for c, _ in found], axis=1).astype(np.uint8)
                codes += [row.tobytes().hex() for row in code]
                errors += [min(int(e), _LARGEST) for e in sum(d for _, d in found)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                ["vec_id", "label", "code", "error"])
    return run


def kept(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, embedding as doubles) of the rows whose vector is whole and finite."""
    v = F.col("embedding")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding").where(
        v.isNotNull() & fine).withColumn("embedding", v.cast("array<double>"))


class Codebooks:
    """Entries of every part position, fitted on all rows of ``vectors``."""

    def __init__(self, vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES):
        longest = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
        self.width = max(-(-longest // PARTS) * PARTS, PARTS)
        # the first rows by vec_id: a top-k of at most ``entries`` rows
        first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
        start = integers([np.array(r["embedding"], np.float64) for r in first], self.width)
        self.entries = start.reshape(len(start), PARTS, self.width // PARTS).transpose(1, 0, 2)
        for _ in range(rounds if len(start) else 0):
            self._move(vectors)

    def _move(self, vectors: DataFrame) -> None:
        sums = vectors.select("embedding").mapInArrow(
            _adder(self.entries, self.width), "part int, entry int, position int, limb int, value long").groupBy(
            "part", "entry", "position", "limb").agg(F.sum("value").alias("value"))
        total, size = {}, self.width // PARTS
        for r in sums.collect():             # parts x entries x positions x limbs, whatever the number of rows
            key = (r["part"], r["entry"], r["position"])
            total[key] = total.get(key, 0) + (r["value"] << _LIMB * r["limb"])
        moved = self.entries.astype(object)
        for (p, c, k), n in total.items():
            if k == -1:
                moved[p, c] = [total.get((p, c, at), 0) // n for at in range(size)]
        small = max((abs(x) for x in moved.reshape(-1)), default=0) < (1 << 29) // _padded(size)
        self.entries = moved.astype(np.int64) if small else moved

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for x in self.entries.reshape(-1)).encode()).hexdigest()

    def codes(self, vectors: DataFrame) -> DataFrame:
        """(vec_id, label, code, error) of each row."""
        label = vectors.schema["label"].dataType.simpleString()
        return vectors.mapInArrow(_coder(self.entries, self.width),
                                  f"vec_id long, label {label}, code string, error long")


def compressed(embeddings: DataFrame, broadcast_labels: int = BROADCAST_LABELS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each kept row."""
    vectors = stash(kept(embeddings), "vectors", release=False)
    books = Codebooks(vectors)
    found = stash(books.codes(vectors), "vector-codes", release=False)
    limit = F.lit(_LARGEST).cast("decimal(38,0)")
    sums = found.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("s")).select(
        F.col("label").alias("of_label"), F.least("s", limit).cast("long").alias("label_error"))
    sums = stash(sums, "label-errors", release=False)
    if sums.limit(broadcast_labels + 1).count() <= broadcast_labels:
        sums = F.broadcast(sums)
    return found.join(sums, F.col("label").eqNullSafe(F.col("of_label")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


ORACLE_SQL = """
WITH RECURSIVE kept AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
           list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
    SELECT r, vec_id, label, p, list_slice(v, p * len(v) // 8 + 1, (p + 1) * len(v) // 8) AS x
    FROM kept, range(8) AS parts(p)),
rounds(n, p, entries) AS (
    SELECT 0, p, list(x ORDER BY r) FROM parts WHERE r <= 16 GROUP BY p
    UNION ALL
    SELECT * FROM (
        WITH near AS (
            SELECT b.n, a.p, a.x, b.entries, list_transform(b.entries, lambda e:
                       list_sum(list_transform(list_zip(a.x, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS d
            FROM parts a JOIN rounds b ON a.p = b.p WHERE b.n < 6),
        chosen AS (SELECT n, p, x, entries, list_position(d, list_min(d)) AS c FROM near),
        sums AS (
            SELECT n, p, c, k, any_value(entries) AS entries, count(*)::BIGINT AS m, sum(x[k])::BIGINT AS s
            FROM (SELECT n, p, c, x, entries, unnest(range(1, len(x) + 1)) AS k FROM chosen) GROUP BY n, p, c, k),
        moved AS (
            SELECT n, p, c, any_value(entries) AS entries, list((s - ((s % m) + m) % m) // m ORDER BY k) AS e
            FROM sums GROUP BY n, p, c),
        listed AS (
            SELECT n, p, any_value(entries) AS entries, list(c ORDER BY c) AS cs, list(e ORDER BY c) AS es
            FROM moved GROUP BY n, p)
        SELECT n + 1, p, list_transform(range(1, len(entries) + 1), lambda c:
                   coalesce(es[list_position(cs, c)], entries[c]))
        FROM listed)),
final AS (SELECT p, entries FROM rounds WHERE n = 6),
found AS (
    SELECT a.r, a.vec_id, a.label, a.p, list_transform(b.entries, lambda e:
               list_sum(list_transform(list_zip(a.x, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS d
    FROM parts a JOIN final b ON a.p = b.p),
codes AS (
    SELECT r, vec_id, label, string_agg(printf('%02x', list_position(d, list_min(d)) - 1), '' ORDER BY p) AS code,
           sum(list_min(d))::BIGINT AS error
    FROM found GROUP BY r, vec_id, label),
book AS (SELECT sha256(string_agg(array_to_string(flatten(entries), ','), ',' ORDER BY p)) AS s FROM final)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, s AS codebooks_sha256
FROM codes, book
"""
