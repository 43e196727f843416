"""Polynomial fingerprints and exact deduplication."""

import random

import pytest

from riskmart.llm import exact_dedup as m
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, keep_id string, f1 string"


def rows_of(pairs):
    return [(i, t, "en", "x", "y") for i, t in pairs]


CASES = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "b" * 30_000), (6, "b" * 30_000), (7, "b" * 29_999 + "c"),
         (None, "a"), (None, "n"), (9, "é\u0000"), (10, "é\u0000"), (11, "z")]


@pytest.mark.parametrize("options", [{}, {"chunk_bytes": 4096}, {"weaken": 1}, {"weaken": 2, "bucket_bytes": 4}])
def test_like_brute(spark, options):
    docs = spark.createDataFrame(rows_of(CASES), SCHEMA)
    got = [tuple(r) for r in m.decide(docs, **options).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute.dedup(CASES)))


def test_repeated_rows_leave_one(spark):
    pairs = [(1, "a"), (1, "a"), (1, "b"), (2, "b"), (2, "b")]
    docs = spark.createDataFrame(rows_of(pairs), SCHEMA)
    got = sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in m.decide(docs).collect())
    assert got == [(1, 1, 2, False), (1, 1, 2, True), (1, 2, 3, False), (2, 2, 3, False), (2, 2, 3, True)]
    left = m.deduplicated(docs)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in left.collect()) == [(1, "a"), (2, "b")]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert m.decide(docs).count() == 0 and m.deduplicated(docs).count() == 0


def test_values_combine_by_shifted_sums():
    rng = random.Random(1)
    data = bytes(rng.randrange(256) for _ in range(50_000))
    direct = [sum((b + 1) * pow(q, i, m.PRIME) for i, b in enumerate(data)) % m.PRIME for q in m.POINTS]
    assert m.chunk_value(data) == direct
    for cut in (0, 1, 8192, 30_001, 50_000):
        assert m.joined_value(m.chunk_value(data[:cut]), cut, m.chunk_value(data[cut:])) == direct


def test_comparison_stops_at_chunks():
    assert m.same_bytes(b"abc" * 9, b"abc" * 9, 4)
    assert not m.same_bytes(b"abc" * 9, b"abc" * 8 + b"abd", 4) and not m.same_bytes(b"a", b"ab", 4)
