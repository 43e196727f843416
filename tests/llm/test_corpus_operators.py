"""Quality sample, decontamination, components and the pipeline."""

import random

import numpy as np

import corpus_pipeline
from riskmart.llm import decontaminate, quality_resampling
from riskmart.llm.common import components, table

SCHEMA = "doc_id long, text string, lang string, ratio string, n long"
SF = "/root/testdata/sf0.001"


def test_quality_separates_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels")
    seen = {r["doc_id"]: (r["quality"], r["toxic"]) for r in labels.collect()}
    found, cut = quality_resampling.scores(table(spark, sf, "documents"), labels)
    rows = [(r["ratio"] >= cut, r["good"]) for r in found.where("good is not null").collect()]
    assert np.mean([a == b for a, b in rows]) > 0.95
    ids = {r["doc_id"] for r in quality_resampling.sampled(table(spark, sf, "documents"), labels).collect()}
    clean = [i for i, x in seen.items() if x == (1, 0)]
    poor = [i for i, x in seen.items() if x[0] == 0]
    assert np.mean([i in ids for i in clean]) > 0.95 and np.mean([i in ids for i in poor]) < 0.2


def test_quality_drops_toxic_prose(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("abdeilnorst", k=rng.randrange(2, 9))) for _ in range(3000)]
    abuse = ["idiot", "scum", "moron", "ordure", "abschaum"]
    prose = lambda: rng.choices(words, k=rng.randrange(30, 400))
    docs, labels = [], []
    for i in range(1200):
        toxic, poor, said = i % 6 == 0, i % 6 == 1, prose()
        if toxic:
            for _ in range(3):
                said.insert(rng.randrange(len(said)), rng.choice(abuse))
        docs.append((i, " | ".join(said) if poor else " ".join(said).capitalize() + ".", "en", "x", 1))
        if i < 800:
            labels.append((i, int(not poor), int(toxic)))
    kept = {r["doc_id"] for r in quality_resampling.kept(
        spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    for some in (range(800), range(800, 1200)):             # labelled ones, and others
        assert np.mean([i in kept for i in some if i % 6 == 0]) < 0.05
        assert np.mean([i in kept for i in some if i % 6 > 1]) > 0.95


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "x", 1), (1, "a b", "en", "x", 1), (None, None, "en", "x", 1),
                                  (2, "", "en", "x", 1)], SCHEMA)
    labels = spark.createDataFrame([(1, 1, 0), (1, None, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality_resampling.kept(docs, labels).count() == 4
    assert quality_resampling.kept(docs.limit(0), labels.limit(0)).count() == 0


def test_kth_largest(spark):
    values = [random.Random(1).gauss(0, 5) for _ in range(500)] + [3.0] * 5
    keys = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 7, 100, 505):
        assert quality_resampling.kth_largest(keys, "v", k, bins=16) == sorted(values)[-k]


def test_leaks(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    items = [[word() for _ in range(30)] for _ in range(8)]
    prose = lambda n: [word() for _ in range(n)]
    edited = [w if k % 7 else word() for k, w in enumerate(items[2])]
    rows = [(1, prose(80)), (2, prose(20) + items[0] + prose(20)), (3, prose(9) + edited + prose(9)),
            (4, [w.upper() + "," for w in items[1]]), (5, items[3][:6] + prose(50)), (2, prose(20) + items[0])]
    docs = spark.createDataFrame([(i, " ".join(t), "en", "x", 1) for i, t in rows] + [(6, None, "en", "x", 1)], SCHEMA)
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)] + [(90, None), (91, "")],
                                  "item_id long, text string")
    for settings in (decontaminate.Settings(), decontaminate.Settings(block_words=60)):
        got = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(spark, docs, bench, settings).collect()}
        assert got == {(2, 0), (3, 2), (4, 1)}
    left = decontaminate.clean(spark, docs, bench)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 5, 6]
    assert decontaminate.clean(spark, docs, bench.limit(0)).count() == 7


def test_repeated_items_do_not_fill_a_block(spark):
    items = [(i, " ".join(f"w{i}x{k}" for k in range(10))) for i in range(40)] + [(None, "no id"), (3, None)]
    rows = spark.createDataFrame(items + items[:1] * 2000 + items[-2:] * 3, "item_id long, text string")
    blocks = list(decontaminate.blocks_of(rows, 100))
    assert max(sum(len(t.split()) for _, t in b) for b in blocks) <= 200
    assert sorted(str(x) for b in blocks for x in b) == sorted(str((i, (t or "").encode())) for i, t in items)


def test_alignment_like_the_full_table():
    rng = np.random.default_rng(4)
    for _ in range(40):
        a, b = rng.integers(0, 6, rng.integers(1, 25)), rng.integers(0, 6, rng.integers(1, 25))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        score, start, end = decontaminate.align(a, b)
        assert score == h.max() and 0 <= start <= end <= len(a)


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(20, 60)] + [(5, k) for k in range(100, 140)] + [(7, 5)]
    got = {r["id"]: r["component_id"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 20 for k in range(20, 61)} | {k: 5 for k in [5, 7, *range(100, 140)]}


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    count, columns = docs.count(), docs.columns
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids"] and 0 < out.count() < count
    assert len(corpus_pipeline.STAGES) == 5
    assert corpus_pipeline.benchmark(spark, docs, SF).columns == columns
