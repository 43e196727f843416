"""The pipeline against plain versions of its stages, and odd columns and tables."""

import os
import random
import tempfile
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskmart.llm import decontaminate, exact_dedup, quality_resampling, signature_tree
from riskmart.llm.common import table
from riskmart.llm.queries import PIECES
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ABUSE = ["idiot", "scum", "moron"]


def fixture(seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abdeilnorst", k=rng.randrange(2, 9))) for _ in range(2500)]
    prose = lambda n: rng.choices(words, k=n)
    say = lambda ws: " ".join(ws).capitalize() + "."
    docs, labels = [], []
    for i in range(500):
        toxic, poor, said = i % 7 == 0, i % 7 == 1, prose(rng.randrange(40, 200))
        if toxic:
            for _ in range(3):
                said.insert(rng.randrange(len(said)), rng.choice(ABUSE))
        docs.append((i, " | ".join(said) if poor else say(said)))
        if i < 350:
            labels.append((i, int(not poor), int(toxic)))
    clean = [d for d in docs if d[0] % 7 > 1]
    bench = [(k, say(prose(30))) for k in range(12)] + [(90, None), (91, ""), (3, "again")]
    for k in range(30):                       # exact copies, some of them several times, and rows that repeat
        docs += [(1000 + 10 * k + j, clean[k][1]) for j in range(1 + k % 3)]
    docs += [docs[2], docs[2], (None, docs[3][1]), (None, None), (2000, ""), (2001, None), (2001, None)]
    for k in range(30, 70):                   # near copies: a word changed, and chains of them
        said = clean[k][1].split()
        for j in range(1 + k % 3):
            said[rng.randrange(len(said))] = rng.choice(words)
            docs.append((3000 + 10 * k + j, " ".join(said)))
    for k in range(12):                       # leaks: whole, edited, and within prose
        item = bench[k][1].split()
        if k % 3 == 1:
            item[10] = "changed"
        docs.append((5000 + k, " ".join(prose(60) + item + prose(60)) if k % 3 else " ".join(item)))
    rng.shuffle(docs)
    return docs, labels, bench


@pytest.fixture(scope="module")
def sf(spark):
    docs, labels, bench = fixture()
    folder = tempfile.mkdtemp(prefix="run-")
    made = {"documents": spark.createDataFrame([(i, t, "en", f"s{k % 3}", len(t or "")) for k, (i, t) in enumerate(docs)], DOCS),
            "labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
            "benchmark": spark.createDataFrame(bench, "item_id long, text string")}
    for name, df in made.items():
        df.write.parquet(os.path.join(folder, f"{name}.parquet"))
    return folder


def exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return [(max(ids, key=lambda i: (i is not None, i or 0)), t) for t, ids in groups.items()]


def near(rows):
    """Of each group of linked sets one document; empty ones are groups of their own."""
    sets = [brute.shingles(t, 5) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for k, a in enumerate(sets):
        for j in range(k):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[max(root(k), root(j))] = min(root(k), root(j))
    return [root(k) if s else ("empty", k) for k, s in enumerate(sets)]


def bare(text):
    edges = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
    return [w for w in (w.strip(edges) for w in "".join(c.lower() if c.isascii() else c for c in text or "").split()) if w]


def score(text, item):
    best, row = 0, [0] * (len(text) + 1)
    for w in item:
        new = [0]
        for k, x in enumerate(text):
            new.append(max(0, row[k] + (2 if x == w else -1), row[k + 1] - 1, new[k] - 1))
        best, row = max(best, *new), new
    return best


def leaks(rows, items):
    found = set()
    grams = lambda ws: {tuple(ws[k: k + 4]) for k in range(max(len(ws) - 3, 1))} if ws else set()
    for i, t in rows:
        said = bare(t)
        for k, text in items:
            item = bare(text)
            if item and grams(said) & grams(item) and score(said, item) >= 2 * min(0.5 * len(item), 25):
                found.add((i, k))
    return found


def test_stages_equal_plain_versions(spark, sf):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs, _, bench = fixture()
    rows = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    kept = corpus_pipeline.quality(spark, table(spark, sf, "documents"), sf)
    kept = spark.createDataFrame(kept.collect(), kept.schema)
    held = rows(kept)
    assert not Counter(held) - Counter((i, t) for i, t in docs)
    once = corpus_pipeline.exact(spark, kept, sf)
    once = spark.createDataFrame(once.collect(), once.schema)
    assert sorted(map(str, rows(once))) == sorted(map(str, ((i, t) for i, t in (
        (i, next(x for j, x in held if j == i and (x or "") == t)) for i, t in exact(held)))))
    apart = corpus_pipeline.near(spark, once, sf)
    apart = spark.createDataFrame(apart.collect(), apart.schema)
    groups = near(rows(once))
    of = {str(r): g for r, g in zip(rows(once), groups)}
    assert Counter(of[str(r)] for r in rows(apart)) == Counter(dict.fromkeys(groups, 1))
    assert len(rows(apart)) < len(rows(once)) < len(held) < len(docs)
    clean = corpus_pipeline.benchmark(spark, apart, sf)
    leaked = {i for i, _ in leaks(rows(apart), bench)}
    assert len(leaked) >= 8
    assert sorted(map(str, rows(clean))) == sorted(str(r) for r in rows(apart) if r[0] not in leaked)
    clean = spark.createDataFrame(clean.collect(), clean.schema)
    ids = {r["doc_id"]: (r["n_tokens"], r["ids"]) for r in corpus_pipeline.tokens(spark, clean, sf).collect()}
    assert ids == {i: (len(library.encode(t or "")), library.encode(t or "")) for i, t in rows(clean)}
    # and run() is these stages one after the other
    out = {r["doc_id"]: (r["n_tokens"], r["ids"]) for r in corpus_pipeline.run(spark, sf).collect()}
    assert out == ids


def test_matches_equal_plain_version(spark, sf):
    docs, _, bench = fixture()
    found = decontaminate.matches(spark, table(spark, sf, "documents"), table(spark, sf, "benchmark")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == leaks(docs, bench)
    words = {i: bare(t) for i, t in docs}
    items = {k: bare(t) for k, t in bench}
    for r in found:
        assert r["score"] == score(words[r["doc_id"]], items[r["item_id"]])


def plain_ratios(docs, folds, settings):
    """ratio of every (id, text) by dictionaries; folds: id -> part of a good labelled document."""
    grams = quality_resampling.Grams()
    found = {(i, t): grams.text((t or "").encode())[0].tolist() for i, t in docs}
    raw, target = Counter(), {0: Counter(), 1: Counter()}
    for i, t in docs:
        raw.update(found[i, t])
        if i in folds:
            target[folds[i]].update(found[i, t])
    every = range(quality_resampling.BUCKETS)
    assert all(0 <= g < quality_resampling.BUCKETS for g in raw) and len(every)
    n = sum(raw.values())

    def model(counts):
        share = max(sum(counts.values()), 1) / max(n, 1)
        return lambda g: np.log((counts[g] + settings.prior * share) / ((raw[g] + settings.prior) * share))
    models = {0: model(target[1]), 1: model(target[0]), None: model(target[0] + target[1])}
    return {(i, t): sum(models[folds.get(i)](g) for g in found[i, t]) / (len(found[i, t]) + 8) for i, t in docs}


def test_ratios_equal_plain_version(spark, sf):
    docs, labels, _ = fixture()
    settings = quality_resampling.Settings()
    known = {r["id"]: r for r in quality_resampling.labelled(table(spark, sf, "labels"), settings.label_rows).collect()}
    folds = {i: r["part"] for i, r in known.items() if r["good"]}
    # a bad labelled document is scored by its part's model too, though it is in no target
    scored = {i: r["part"] for i, r in known.items()}
    expected = plain_ratios(docs, folds, settings)
    grams = quality_resampling.Grams()
    assert grams.text(b"")[0].size == 0
    found, cut = quality_resampling.scores(table(spark, sf, "documents"), table(spark, sf, "labels"))
    texts = {(r["doc_id"], r["h"]): r["text"] for r in table(spark, sf, "documents").select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text").collect()}
    rows = found.collect()
    assert len(rows) == len(docs) and cut is not None
    for r in rows:
        if r["doc_id"] in folds or r["doc_id"] not in scored:
            assert abs(r["ratio"] - expected[r["doc_id"], texts[r["doc_id"], r["text_hash"]]]) < 1e-9
    ids = {r["doc_id"] for r in quality_resampling.kept(table(spark, sf, "documents"), table(spark, sf, "labels")).collect()}
    assert np.mean([i in ids for i, q, t in labels if q and not t]) > 0.95
    assert np.mean([i in ids for i, q, t in labels if t]) < 0.1 and np.mean([i in ids for i, q, t in labels if not q]) < 0.1


ODD = ["_id", "_hash", "_key", "_place", "_row_key", "_every", "row", "row_id", "row_key", "b", "a.b", "x`y", "text_hash", "n"]


def test_columns_of_any_name(spark, sf):
    rows = [(1, "a b c d e f", *(f"{c}1" for c in ODD), {"k": 1}), (1, "a b c d e f", *(f"{c}1" for c in ODD), {"k": 2}),
            (2, "a b c d e f", *(f"{c}2" for c in ODD), None), (3, "one two three four five six", *(None for _ in ODD), {"z": 3}),
            (None, None, *(f"{c}4" for c in ODD), {})]
    quoted = ", ".join("`" + c.replace("`", "``") + "` string" for c in ODD)
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {quoted}, m map<string,int>")
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        got = out.collect()
        assert len(got) == {"quality": len(got), "exact_dedup": 3, "near_dedup": 3, "decontamination": 5}[name], name
        for r in got:
            assert any(tuple(r) == tuple(x) for x in rows), (name, r)
    assert corpus_pipeline.tokens(spark, docs, sf).count() == 5


def test_stages_of_nothing(spark, sf):
    docs = table(spark, sf, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0


def test_long_texts(spark, sf):
    rng = random.Random(8)
    long = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(200_000))          # 1.4 MB
    rows = [(1, long), (2, long), (3, long + " more words at the end"), (4, "short text here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in exact_dedup.deduplicated(docs).collect()) == [2, 3, 4]
    groups = {r["doc_id"]: r["component_id"] for r in signature_tree.classes(docs, signature_tree.Settings(words=5, percent=80)).collect()}
    assert groups == {1: 1, 2: 1, 3: 1, 4: 4}
