"""The byte network: slopes, held-out accuracy, and odd texts."""

import random
import zlib

import numpy as np

from riskmart.llm import byte_language
from riskmart.llm.common import table

SF = "/root/testdata/sf0.01"


def test_slopes_equal_differences():
    rng = np.random.default_rng(0)
    net = byte_language.Network.fresh(["a", "b", "c"], 4, rng)
    for name in ("seen", "state", "out", "bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    windows, truth = rng.integers(0, 256, (5, 7)).astype(np.uint8), np.array([0, 1, 2, 0, 1])
    slopes = net.gradients(windows, truth)[1]
    for w, slope in zip(net.weights(), slopes):
        for _ in range(6):
            at = tuple(int(rng.integers(0, s)) for s in w.shape)
            if w is net.seen:
                at = (*at[:2], int(windows[0, 0]), at[3])
            old, sides = w[at], []
            for step in (1e-2, -1e-2):
                w[at] = old + step
                sides.append(net.gradients(windows, truth)[0])
            w[at] = old
            assert abs((sides[0] - sides[1]) / 2e-2 - slope[at]) < 2e-4


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    langs = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    net = byte_language.fitted(docs)
    found = byte_language.predicted(docs, net).collect()
    assert len(found) == len(langs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert all(0 <= r["score"] <= 1 for r in found)
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in found if r["held_out"]]) > 0.97
    # positions: half a text in each of two languages
    halves = {lang: next(r["text"] for r in docs.where(f"lang = '{lang}' and n_chars between 600 and 4000").orderBy(
        "doc_id").collect())[:500] for lang in ("de", "es")}
    text = halves["de"] + halves["es"]
    runs = byte_language.labelled(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"), net).collect()
    by_id = {r["doc_id"]: r["runs"] for r in runs}
    assert by_id[2] == [] and by_id[1][0]["start"] == 0 and by_id[1][-1]["end"] == len(text.encode())
    assert all(a["end"] == b["start"] and a["lang"] != b["lang"] for a, b in zip(by_id[1], by_id[1][1:]))
    cut = len(halves["de"].encode())
    right = sum(max(0, min(r["end"], cut) - r["start"]) for r in by_id[1] if r["lang"] == "de") + sum(
        max(0, r["end"] - max(r["start"], cut)) for r in by_id[1] if r["lang"] == "es")
    assert right > 0.9 * len(text.encode())


def test_odd_texts(spark):
    rng = random.Random(2)
    say = lambda letters: " ".join("".join(rng.choices(letters, k=5)) for _ in range(40))
    rows = [(i, say("abcde" if i % 2 else "vwxyz"), "a" if i % 2 else "v", "s") for i in range(60)]
    odd = [(100, None, "a", "s"), (101, "", "a", "s"), (102, "1234 !?", "v", "s"), (103, "x", None, "s"),
           (None, "abcde", "a", "s"), (None, "abcde", "a", "s"), (104, "vwxyz " * 200_000, None, "s")]
    frame = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, held_out string")
    found = byte_language.predicted(frame, byte_language.fitted(frame)).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == 67
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (100, 101, 102))
    assert by_id[104]["lang_pred"] == "v" and by_id[None]["lang_pred"] == "a" and by_id[None]["held_out"]
    assert all(by_id[i]["lang_pred"] == ("a" if i % 2 else "v") for i in range(60))


def test_nothing_to_learn(spark):
    frame = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    for docs in (frame, frame.limit(0)):
        net = byte_language.fitted(docs)
        assert net is None
        assert [r["lang_pred"] for r in byte_language.predicted(docs, net).collect()] == ["und"] * docs.count()


def test_windows_hold_every_byte():
    texts = [b"", b"a" * 128, b"b" * 129, b"c"]
    read = [b""] * len(texts)
    for windows, of, n in byte_language._windows(texts):
        for w, k, size in zip(windows, of, n):
            read[k] += w[:size].tobytes()
    assert read == texts
