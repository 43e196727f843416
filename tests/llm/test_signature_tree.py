"""The n-gram Jaccard join against all pairs."""

import random

import numpy as np
import pytest

from riskmart.llm import signature_tree as m
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, node long, window string"


def corpus(seed: int, count: int = 60) -> list[tuple]:
    """Texts, edited copies of texts, and a passage that many share."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    passage = rng.choices(words, k=40)
    texts = []
    for k in range(count):
        if texts and rng.random() < 0.5:
            t = list(rng.choice(texts))
            for _ in range(rng.randrange(4)):
                t[rng.randrange(len(t))] = rng.choice(words)
            texts.append(t + rng.choices(words, k=rng.randrange(3)))
        else:
            texts.append(rng.choices(words, k=rng.randrange(1, 120)) + (passage if rng.random() < 0.4 else []))
    out = [(k, " ".join(t).replace("w1", "W1")) for k, t in enumerate(texts)]
    return out + [(count, None), (count + 1, ""), (count + 2, " \t\n"), (count + 3, "one"), (count + 4, "ONE"),
                  (count + 5, "one two"), (None, out[0][1]), (None, "alone here"), (None, None)]


@pytest.mark.parametrize("settings", [
    m.Settings(words=3, percent=90), m.Settings(words=5, percent=80), m.Settings(words=3, percent=70),
    m.Settings(words=2, percent=60, cell_nodes=4)])
def test_like_all_pairs(spark, settings):
    rows = corpus(settings.percent + settings.words)
    docs = spark.createDataFrame([(i, t, "en", 7, "x") for i, t in rows], SCHEMA)
    got = m.classes(docs, settings).select("doc_id", "n_shingles", "component_id").collect()
    expected = brute.near(rows, settings.words, settings.percent)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_one_of_each(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(5, text), (3, text + " x"), (9, text.upper()), (1, "other words " * 9), (4, ""), (6, None), (3, text + " x")]
    docs = spark.createDataFrame([(i, t, "en", 7, "x") for i, t in rows], SCHEMA)
    left = m.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in left.na.fill("-", ["text"]).collect()) == [
        (1, "other words " * 9), (3, text + " x"), (4, ""), (6, "-")]


def test_empty_table(spark):
    assert m.classes(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("across", [False, True])
def test_dual_walk_loses_no_link(across):
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(70):
        if sets and rng.random() < 0.6:
            s = sets[rng.integers(len(sets))].copy()
            s[rng.integers(len(s))] = rng.integers(1 << 60)
        else:
            s = rng.integers(0, 1 << 60, rng.integers(1, 90)).astype(np.uint64)
        sets.append(np.unique(s.astype(np.uint64)))
    left, right = (m.Tree(sets[:30], 512), m.Tree(sets[30:], 512)) if across else (m.Tree(sets, 512),) * 2
    found = set()
    for a, b in m.dual_walk(left, right, 80, not across):
        p, q = left.order[a], right.order[b] + 30 * across
        found |= {tuple(sorted(x)) for x in zip(p.tolist(), q.tolist())}
    want = {(i, j) for i in range(70) for j in range(i + 1, 70)
            if (not across or i < 30 <= j) and m.linked(sets[i], sets[j], 80)}
    assert want and want <= found and len(found) < 70 * 69 / 4
