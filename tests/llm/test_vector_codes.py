"""Vector codes against plain integer arithmetic, and odd rows."""

import hashlib
import math
import random
from collections import defaultdict
from fractions import Fraction

import numpy as np

from riskmart.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, part string"


def plain(rows):
    """The contract read literally, on (vec_id, vector, label) rows of one width, with Python integers."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = max(-(-max(len(r[1]) for r in rows) // 8) * 8, 8)
    whole = [[math.floor(4096 * Fraction(x)) for x in r[1]] + [0] * (width - len(r[1])) for r in rows]
    size = width // 8
    cut = lambda v, p: v[p * size: (p + 1) * size]
    books = [[cut(v, p) for v in whole[:16]] for p in range(8)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, book: min((gap(x, e), c) for c, e in enumerate(book))
    for _ in range(6):
        for p in range(8):
            groups = defaultdict(list)
            for v in whole:
                groups[near(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [[sum(z) // len(groups[c]) for z in zip(*groups[c])] if groups[c] else e
                        for c, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found, by_label = [], defaultdict(int)
    for r, v in zip(rows, whole):
        got = [near(cut(v, p), books[p]) for p in range(8)]
        error = sum(d for d, _ in got)
        by_label[r[2]] += error
        found.append((r[0], "".join(f"{c:02x}" for _, c in got), error, r[2]))
    top = (1 << 63) - 1
    return sorted(((i, code, min(e, top), min(by_label[lab], top), digest) for i, code, e, lab in found), key=str)


def of(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(5)
    return sorted((tuple(r) for r in vector_codes.compressed(frame, **options).collect()), key=str)


def test_codes_equal_plain_arithmetic(spark):
    rng = random.Random(3)
    for width, n in ((8, 40), (24, 120), (21, 60)):
        rows = [(i * 7 % 1000, [rng.gauss(0, 1) for _ in range(width)], rng.choice([1, 2, None])) for i in range(n)]
        rows += [(5000 + i, rows[0][1], 1) for i in range(9)]                     # copies
        rows += [(6000, None, 1), (6001, [None] * width, 1), (6002, [math.nan] * width, 1), (6003, [math.inf] * width, 2),
                 (None, rows[3][1], 2)]
        assert of(spark, rows) == plain(rows)
        assert of(spark, rows, broadcast_labels=0) == plain(rows)


def test_ties_few_rows_and_odd_lengths(spark):
    rows = [(3, [1.0] * 8, 1), (1, [0.0] * 8, None), (2, [0.5] * 8, 1), (4, [0.25] * 3, 1), (4, [], 1), (4, [], 1)]
    assert of(spark, rows) == plain(rows)
    assert of(spark, rows[:1]) == plain(rows[:1])
    assert of(spark, []) == []


def test_huge_components_stay_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) * 10 ** rng.choice([0, 6, 12, 30, 300]) for _ in range(16)], i % 2) for i in range(30)]
    assert of(spark, rows) == plain(rows)
    middle = [(i, [rng.uniform(-3e4, 3e4) for _ in range(8)], 1) for i in range(40)]
    assert of(spark, middle) == plain(middle)


def test_transform_keeps_distances_in_order_of_sequency():
    for n in (1, 2, 4, 8, 32):
        waves = vector_codes.transformed(np.eye(n, dtype=np.int64)).T
        changes = [(np.diff(w) != 0).sum() for w in waves]
        assert changes == list(range(n))
        assert (waves @ waves.T == n * np.eye(n)).all()
    rng = np.random.default_rng(1)
    parts, entries = rng.integers(-9, 9, (500, 5)), rng.integers(-9, 9, (16, 5))
    gaps = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    code, gap = vector_codes.nearest(parts, entries)
    assert (code == gaps.argmin(axis=1)).all() and (gap == gaps.min(axis=1)).all()
