"""Operators on single texts against plain versions: secrets, token files, substrings, personal data, pieces, chats."""

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from riskmart.llm import chat_template, huffman_ids, secret_scan, suffix_dedup, viterbi_pieces, weak_pii
from riskmart.llm.common import new_path
from riskmart.llm.queries import PIECES, WORD_BPE
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, bits string, kept boolean"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x", True) for i, t in rows], SCHEMA)


def by_text(rows):
    return sorted(map(str, rows))


TEXTS = [None, "", "plain words only", "token = 'abcdefgh12' and 0123456789abcdef0123456789abcdef tail",
         "é PASSWORD:xyzzyxyzzy AKIAABCDEFGHIJKL AKIA1 api_key=short", "Secret=" + "a" * 40,
         "x@y.com, a.b@c@d.example.org 1.2.3.4.5.6.7.8 999.1.1.1 4845168114407329 4845168114407328",
         "+1 (743) 555-3824; +12; 2020-01-02 (555) 123-4567 @ a@ @b.c", "déjà ✓ 漢字 \t\n tabs  two",
         "<|endoftext|> And <|ENDOFTEXT|> it's THE end., \x1c x", "word " * 3000, "z" * 5000]


def test_secrets(spark):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, TEXTS[4])]
    kinds = ["assign", "access", "hex"]
    want = []
    for i, t in rows:
        s = brute.secrets(t)
        want.append((i, *(sum(x[0] == k for x in s) for k in kinds), brute.sha(brute.joined(s, kinds))))
    assert by_text(tuple(r)[:5] for r in secret_scan.scan(frame(spark, rows)).collect()) == by_text(want)
    assert secret_scan.scan(frame(spark, [])).count() == 0


def test_markov_models_part_random_from_ordinary(spark):
    rng = random.Random(5)
    letters = secret_scan.ALPHABET[:62]
    random_token = lambda: "".join(rng.choice(letters) for _ in range(32))
    words = ["configuration", "management", "interface", "connection", "parameter", "translation", "environment"]
    rows = [(i, " ".join(rng.choices(words, k=30))) for i in range(60)]
    rows += [(100 + i, f"token = {random_token()} and more") for i in range(60)]
    rows += [(200 + i, f"found {random_token()} here") for i in range(20)]
    rows += [(300 + i, "_".join(rng.choices(words, k=4)) + " here") for i in range(20)]
    got = {r["doc_id"]: r["n_markov"] for r in secret_scan.scan(frame(spark, rows)).collect()}
    assert sum(got[200 + i] for i in range(20)) >= 19 and not any(got[300 + i] for i in range(20))


def test_markov_threshold_does_not_follow_the_table(spark):
    rng = random.Random(7)
    words = ["configuration", "management", "interface", "connection", "parameter"]
    rows = [(i, " ".join(rng.choices(words, k=30))) for i in range(400)]
    found = []
    for part in (rows[:4], rows):                           # no values of rules, few and many words
        docs = frame(spark, part)
        found.append(secret_scan.train(docs, secret_scan.rules(docs))[1])
    docs = frame(spark, rows + [(1000 + i, f"token = {rng.randrange(10 ** 20)}x") for i in range(300)])
    found.append(secret_scan.train(docs, secret_scan.rules(docs))[1])
    assert len(set(found)) == 1, found


@pytest.mark.parametrize("block_ids", [50, 1 << 16])
def test_token_files(spark, block_ids):
    from tokenizers import Tokenizer
    rows = [(7 * i - 20, t) for i, t in enumerate(TEXTS)]
    path = new_path(spark, "test-ids")
    huffman_ids.write(frame(spark, rows[::-1]), path, WORD_BPE, block_ids=block_ids)
    got = [tuple(r) for r in huffman_ids.digests(spark, path).collect()]
    assert sorted(got) == brute.token_rows(rows, Tokenizer.from_file(WORD_BPE))


def test_token_files_odd_rows(spark):
    path = new_path(spark, "test-ids")
    huffman_ids.write(frame(spark, []), path, WORD_BPE)
    assert huffman_ids.digests(spark, path).count() == 0
    path = new_path(spark, "test-ids")
    huffman_ids.write(frame(spark, [(None, "a"), (1, "b"), (1, "b"), (1, None)]), path, WORD_BPE)
    got = sorted(((r["start"], r["n_tokens"]) for r in huffman_ids.digests(spark, path).collect()))
    assert [s for s, _ in got] == list(np.cumsum([0] + [n for _, n in got])[:-1])


def test_token_files_refuse_ids_over_16_bits():
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2], pa.int64()), pa.array(["a b", ""])], ["doc_id", "text"])
    out, = huffman_ids._tokenizer(WORD_BPE, 0xFFFF)([batch])
    assert [x.as_py()[-2:] for x in out.column("ids")] == [b"\xff\xff"] * 2
    with pytest.raises(ValueError):
        list(huffman_ids._tokenizer(WORD_BPE, 1 << 16)([batch]))


def test_limited_codes():
    rng = np.random.default_rng(2)
    for counts in (np.array([5]), np.array([1, 1]), 2 ** np.arange(30), rng.integers(1, 1000, 3000)):
        limit = 12 if len(counts) > 100 else 8
        bits = huffman_ids.limited_lengths(counts, limit)
        assert bits.max() <= limit and (0.5 ** bits).sum() <= 1
        book = huffman_ids.Codebook(np.arange(len(counts)) * 3, bits)
        ids = rng.integers(0, len(counts), 700) * 3
        packed = [(*book.pack(x, 16), len(x)) for x in (ids[:300], ids[300:301], ids[301:])]
        assert np.array_equal(np.concatenate(book.unpack(packed, 16)), ids)
    assert list(huffman_ids.limited_lengths(np.array([1, 1, 2, 4]), 16)) == [3, 3, 2, 1]


@pytest.mark.parametrize("group", [1, 50_000])
def test_repeated_substrings(spark, group):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7)))
    shared = [" ".join(word() for _ in range(60)) for _ in range(4)]
    rows = [(k, " ".join(rng.choice([word() * 3, rng.choice(shared), rng.choice(shared)[20:150]])
                         for _ in range(rng.randrange(1, 9)))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, "a" * 400), (103, "ab" * 250), (104, rows[0][1]), (105, "short")]
    got = [tuple(r) for r in suffix_dedup.removals(frame(spark, rows), group).collect()]
    assert sorted(got) == brute.removed(rows)


def test_repeated_substrings_odd_rows(spark):
    text = "".join(map(chr, range(200, 420)))
    rows = [(1, text), (1, text), (None, text), (1, "short"), (1, "short")]
    got = sorted(str((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"]))
                 for r in suffix_dedup.removals(frame(spark, rows)).collect())
    n = len(text.encode())
    assert got == sorted(map(str, [(1, n, 0, 0), (1, n, n, 1), (None, n, n, 1), (1, 5, 0, 0), (1, 5, 0, 0)]))
    assert suffix_dedup.removals(frame(spark, [])).count() == 0


def test_flagged_bytes_are_removed_in_small_parts():
    """Rows, some without flags, of many flagged segments: right bytes, and scratch of a few rows only."""
    rng = random.Random(6)
    texts = [bytes(rng.choices(b"abc ", k=rng.choice([80, 700, 30_000]))) for _ in range(300)]
    flags = [None if k % 7 == 0 else [{"start": a, "starts": min(60, len(t) - 99 - a), "mask": rng.choice([-1, 5, 1 << 59])}
                                      for a in range(0, len(t) - 99, 60) if rng.random() < 0.7] for k, t in enumerate(texts)]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("starts", pa.int32()), ("mask", pa.int64())]))
    batch = pa.RecordBatch.from_pydict({"id": range(300), "text_hash": [0] * 300, "text": [t.decode() for t in texts],
                                        "flags": pa.array(flags, kind)}).slice(2)
    tracemalloc.start()
    got = [r for b in suffix_dedup._remove(iter([batch])) for r in b.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 << 20, peak
    for r, text, marks in zip(got, texts[2:], flags[2:], strict=True):
        gone = [False] * len(text)
        for m in marks or []:
            for i in range(m["starts"]):
                if m["mask"] >> i & 1:
                    at = m["start"] + i
                    gone[at: at + 100] = [True] * 100
        kept = bytes(c for c, g in zip(text, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        assert (r["n_removed"], r["n_spans"]) == (sum(gone), spans)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("job", [suffix_dedup.removals, lambda d: huffman_ids.tokens(d, WORD_BPE)])
def test_python_jobs_return_their_memory(spark, monkeypatch, job):
    frames = type(spark.range(1))
    used, run = [], frames.mapInArrow
    monkeypatch.setattr(frames, "mapInArrow", lambda self, f, *a, **k: used.append(f) or run(self, f, *a, **k))
    job(frame(spark, [(1, "a" * 300), (2, "b " * 90)]))
    assert used and all(f.__qualname__.startswith("tidied.") for f in used)


def test_personal_data(spark):
    rows = list(enumerate(TEXTS)) + [(6, TEXTS[6]), (None, TEXTS[7])]
    kinds = list(weak_pii.KINDS)
    want = []
    for i, t in rows:
        s = brute.personal(t)
        want.append((i, *(sum(x[0] == k for x in s) for k in kinds), brute.sha(brute.joined(s, kinds))))
    assert by_text(tuple(r)[:6] for r in weak_pii.classified(frame(spark, rows)).collect()) == by_text(want)
    assert weak_pii.classified(frame(spark, [])).count() == 0


def test_em_finds_unreliable_labelers():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.5
    votes = np.zeros((4000, len(weak_pii.LABELERS)), np.int64)
    for j, right in enumerate((0.95, 0.9, 0.85, 0.55)):
        votes[:, j] = np.where(rng.random(4000) < right, truth, ~truth) * 2 - 1
    pattern, at, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    p = weak_pii.em(pattern, n.astype(float))[at.ravel()]
    assert ((p > 0.5) == truth).mean() > 0.93


def test_pieces(spark):
    model = viterbi_pieces.pieces(PIECES)
    rng = random.Random(8)
    words = ["▁" + "".join(rng.choice("abcdeinorst▁é漢") for _ in range(rng.randrange(1, 14))).replace("▁", "") for _ in range(200)]
    for w in words:
        want = []
        for piece in brute.best_pieces(w, model.scores, model.unknown):
            want += [model.numbers[piece]] if piece in model.numbers else [int(model.byte[b]) for b in piece.encode()]
        ids = np.frombuffer(model.viterbi(np.array([[ord(c) for c in w]], np.uint32))[0], "<u4").tolist()
        assert ids == want, w
    rows = list(enumerate(TEXTS)) + [(None, "a▁b"), (3, TEXTS[3])]
    assert all(r["round_trip"] for r in viterbi_pieces.digests(frame(spark, rows), PIECES).collect())
    back = viterbi_pieces.decoded(viterbi_pieces.encoded(frame(spark, rows), PIECES), PIECES).collect()
    assert by_text(map(tuple, back)) == by_text((i, (t or "").replace("▁", " ")) for i, t in rows)


def test_pieces_are_those_of_the_library(spark):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    model, rng = viterbi_pieces.pieces(PIECES), random.Random(9)
    texts = [t or "" for t in TEXTS] + ["information", "  two   spaces ", " ", "a▁b", "▁▁ x", "</s> <0x41>", "ab" * 4000]
    texts += ["".join(rng.choice("aeinorst  é漢\U0001f600\n.") for _ in range(rng.randrange(1, 900))) for _ in range(200)]
    texts += ["".join(rng.choice("aeinorst") for _ in range(rng.randrange(150, 260))) for _ in range(60)]
    texts += [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text, ids in zip(texts, model.encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text), text[:80]


def test_chats(spark):
    rows = [(1, 1, "assistant", "b</s>\\"), (1, 0, "user", "[INST] a [/INST]"), (2, None, None, None), (2, 0, "tool", "<s>[:]"),
            (None, 3, "system", "<<SYS>>"), (3, 0, "assistant", ""), (3, 0, "assistant", "same"), (3, 0, "assistant", "same")]
    chats = spark.createDataFrame([(*r, "x", 5) for r in rows],
                                  "conv_id long, turn long, role string, text string, formatted string, mask int")
    got = chat_template.digests(chat_template.formatted(chats)).collect()
    assert by_text(tuple(r)[:5] for r in got) == by_text((c, *v) for c, v in brute.chats(rows).items())
    assert chat_template.formatted(chats.limit(0)).count() == 0


def test_a_conversation_over_many_tasks(spark):
    rng = random.Random(11)
    say = lambda: "".join(rng.choices("ab </s>[INST]\\é\n", k=rng.randrange(0, 60)))
    roles = ["user", "assistant", "system", "tool", None]
    rows = [(c, t, rng.choice(roles), say()) for c, n in ((1, 3000), (None, 900), (7, 1), (2, 4), (9, 2500)) for t in range(n)]
    rows += [(c, t, rng.choice(roles), say()) for c in range(100, 900) for t in range(rng.randrange(1, 6))]
    shuffled = random.Random(1).sample(rows, len(rows))
    chats = spark.createDataFrame(shuffled, "conv_id long, turn long, role string, text string").repartition(16)
    for chars in (1, 500, 1 << 18):
        made = chat_template.formatted(chats, chars=chars)
        if chars < 1000:
            assert made.where("conv_id = 1").count() > 100
        got = chat_template.digests(made).collect()
        assert by_text(tuple(r)[:5] for r in got) == by_text((c, *v) for c, v in brute.chats(rows).items())
    whole = chat_template.compile_template(chat_template.TEMPLATE)
    for conv in (1, 2, None):
        messages = [{"role": r or "", "text": t} for c, _, r, t in rows if c == conv]
        blocks = sorted(chat_template.formatted(chats, chars=500).where(F.col("conv_id").eqNullSafe(F.lit(conv))).collect(),
                        key=lambda r: r["block"])
        text, spans = whole(messages)
        assert "".join(b["formatted"] for b in blocks) == text
        at, found = 0, []
        for b in blocks:
            found += [(at + m["start"], at + m["end"]) for m in b["mask"]]
            at += len(b["formatted"])
        assert found == spans and [b["opens"] for b in blocks].count(True) == [b["closes"] for b in blocks].count(True) == 1


def test_templates_that_look_around_are_rendered_whole(spark):
    t = "{% for m in messages %}{{ m.text }}{% if not loop.last %}, {% endif %}{% endfor %}."
    assert chat_template.streamed(t) is None and chat_template.streamed(chat_template.TEMPLATE)
    chats = spark.createDataFrame([(1, k, "user", str(k)) for k in range(4)], "conv_id long, turn long, role string, text string")
    assert [r["formatted"] for r in chat_template.formatted(chats, t).collect()] == ["0, 1, 2, 3."]


def test_secrets_in_a_long_text(spark):
    rng = random.Random(12)
    token = lambda k: "".join(rng.choices("abcdefghijkLMNOPQRS0123456789", k=k))
    parts = []
    while sum(map(len, parts)) < 3_000_000:
        parts.append(rng.choice([f"password = {token(24)}", token(30), "0123456789abcdef" * 3, "é " * 20, "word word",
                                 "AKIA" + "A1B2" * 5, f"token: '{token(9)}'"]) + " ")
    text = "".join(parts)
    made = spark.createDataFrame([(1, text), (2, "password: abcdefgh")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in secret_scan.scan(made).collect()}
    spans = brute.secrets(text)
    base = brute.joined(spans, ["assign", "access", "hex"])
    assert got[1]["base_sha256"] == brute.sha(base) and got[1]["n_assign"] == sum(s[0] == "assign" for s in spans)
    assert got[2]["spans"] == "assign:0:18"


def test_running_sums_and_tokens_apart(spark):
    rng = random.Random(13)
    rows = []
    for n in (0, 1, 2, 3, 4, 5, 16, 17, 200):
        lengths = [rng.randrange(0, 9) for _ in range(n)]
        at = sorted(rng.sample(range(100_000), 2 * n))
        rows.append((lengths, [(a, a + rng.randrange(1, 900)) for a in at[::2]], [(a, a + rng.randrange(1, 40)) for a in at[1::2]]))
    df = spark.createDataFrame(rows, "n array<int>, base array<struct<start:int,end:int>>, tokens array<struct<start:int,end:int>>")
    got = df.select("*", secret_scan.running_sums(F.col("n"), 4).alias("sums"),
                    secret_scan.apart(F.col("tokens"), F.col("base"), 0).alias("many"),
                    secret_scan.apart(F.col("tokens"), F.col("base"), 1 << 30).alias("few")).collect()
    for r in got:
        assert r["sums"] == [sum(r["n"][:k]) for k in range(len(r["n"]))]
        alone = [t for t in r["tokens"] if not any(b["start"] < t["end"] and t["start"] < b["end"] for b in r["base"])]
        assert r["many"] == r["few"] == alone


def test_template_language():
    t = "{% set a = 'x' + 1 %}{% for m in messages %}{% if loop.first and not loop.last %}{{ m.text|upper }}" \
        "{% elif 'q' in m.text %}{% generation %}{{ m.text }}{% endgeneration %}{% else %}-{% endif %}{% endfor %}{{ a }}"
    render = chat_template.compile_template(t)
    assert render([{"role": "u", "text": "hi"}, {"role": "u", "text": "quo"}, {"role": "u", "text": "n"}]) == (
        "HIquo-x1", [(2, 5)])
    folded = chat_template.fold(chat_template.parse("a{{ 'b' + 'c'|upper }}{% if 1 == 2 %}no{% else %}d{% endif %}"))
    assert len(folded) == 2 and folded[0].value.value == "abC"
    for bad in ("{{ messages.__class__ }}", "{{ open }}", "{{ m|eval }}", "{% import os %}", "{{ 1 + }}"):
        with pytest.raises(chat_template.TemplateError):
            chat_template.compile_template(bad)([])


def test_word_hashes_follow_their_plain_definition():
    import re

    from riskmart.llm.common import WordHashes
    from riskmart.llm.quality_resampling import Grams
    words = [b"", b"word", b"Word,", b"...", b"A--b", b"aA1!!", b"x\xc3\xa9Y\xff", b"e.g.", b"(2024)", b"\x00\x80"]
    plain, grams = WordHashes(), Grams()
    for w in words:
        shape = w
        for pattern, by in ((rb"[a-z\x80-\xff]+", b"a"), (rb"[A-Z]+", b"A"), (rb"[0-9]+", b"9"), (rb"(?s)(.)\1+", rb"\1")):
            shape = re.sub(pattern, by, shape)
        edges = bytes(c for c in range(33, 127) if not chr(c).isalnum())
        assert grams.value(w) == (plain.value(b"\0" + w.lower().strip(edges)) % (1 << 32)
                                  | (plain.value(b"\1" + shape) % (1 << 30)) << 32)
    grams = Grams()
    grams.of([b"one,", b"two,", b"two,"])
    assert len(grams) == 2 and len(grams.shapes) == 1       # a shape is hashed once for all words that have it
