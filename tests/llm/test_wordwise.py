"""Words of letters merged by byte ranks against the tokenizers library."""

import random

import numpy as np
import pyarrow as pa

from riskmart.llm import huffman_ids
from riskmart.llm.queries import WORD_BPE
from riskmart.llm.wordwise import LetterMerges, WordwiseBpe, _byte_letters, wordwise

LETTERS = "abcdefghijklmnopqrstuvwxyzéèêçñóßäöüœжя漢éΣσς"


def test_letter_words_equal_the_library():
    merges, rng = LetterMerges(WORD_BPE), random.Random(1)
    library = wordwise(WORD_BPE).tokenizer
    words = {"".join(rng.choices(LETTERS[:rng.choice([26, 36, len(LETTERS)])], k=rng.randrange(1, 14))) for _ in range(6000)}
    with open(__file__, encoding="utf-8") as f:
        words |= {w.lower() for w in f.read().split()}
    told = 0
    for w in sorted(words):
        ids = merges.ids(w.encode())
        if ids is not None:
            told += 1
            assert ids == library.encode(w, add_special_tokens=False).ids, w
    assert told > 4000


def test_texts_equal_the_library(spark):
    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ["Élan élan. don't can't, x² ½ Σας ẞ ŉ İstanbul été naïve.. <|endoftext|> 'tis l'été.", "a" * 5000, "", " \t"]
    model = wordwise(WORD_BPE)
    for text, ids in zip(texts, model.encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == model.tokenizer.encode(text, add_special_tokens=False).ids, text[:60]


def test_signs_after_a_word_equal_the_library():
    rng, model = random.Random(3), wordwise(WORD_BPE)
    words = ["".join(rng.choices("abZ9éİ\u0958'<|>-_漢", k=rng.randrange(0, 4))) + "".join(
        rng.choices(".,!?;:&%*$#'", k=rng.randrange(1, 6))) for _ in range(4000)] + ["no<|endoftext|>.", "<|endoftext|>!!"]
    for word, ids in zip(words, model.encode([w.encode() for w in words])):
        assert np.frombuffer(ids, "<u4").tolist() == model.tokenizer.encode(word, add_special_tokens=False).ids, word


def test_known_words_are_found_without_a_pass_over_all_words(monkeypatch):
    """A remembered word takes one lookup; only words not remembered are worked out, each once."""
    model = WordwiseBpe(WORD_BPE)
    worked = []
    monkeypatch.setattr(model.known, "ids", lambda w, f=model._ids: worked.append(w) or f(w))
    first = model.encode([b"one two one. two", b"one two"])
    assert worked == [b"one", b"two", b"one.", b"."] and model.encode([b"one two one. two", b"one two"]) == first
    assert len(worked) == 4


def library_ids(model, text):
    return model.tokenizer.encode(text or "", add_special_tokens=False).ids


def column_ids(model, texts):
    ids, cuts = model.encode_column(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])]


def test_columns_equal_the_library():
    rng, model = random.Random(4), wordwise(WORD_BPE)
    parts = LETTERS + "ÉÈÑÜßªΣİǅſά̧́АЯ" + ".,!?$*" * 2 + "'\"(-7Z|\x1c" + "     \n\t\x0b\x85\xa0　"
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 40))) for _ in range(4000)]
    texts += [None, "", " ", "\n x \n", "The <|endoftext|> End. It's<|endoftext|>!", "a" * 199 + ".,", "b" * 500, "ΟΔΟΣ", "ét."]
    assert column_ids(model, texts) == [library_ids(model, t) for t in texts]
    assert column_ids(model, texts[7:]) == column_ids(model, texts)[7:]
    array = pa.array(texts, pa.large_string())
    ids, cuts = model.encode_column(array.slice(5, 90))
    assert ids.tolist() == sum((library_ids(model, t) for t in texts[5:95]), []) and len(cuts) == 91
    assert column_ids(model, []) == [] and column_ids(model, [None, " "]) == [[], []]


def test_lists_of_words_equal_the_library():
    """Every word of the vocabulary, for a merge list may not reach a word that it holds."""
    model = wordwise(WORD_BPE)
    words = [w.removesuffix("</w>") for w in model.tokenizer.get_vocab() if w.endswith("</w>")]
    words = [bytes(map(_byte_letters().__getitem__, w)).decode("utf-8", "replace") for w in words if w]
    words = pa.array(words).filter(pa.array(model.lists.holds(pa.array(words))))
    assert len(words) > 20_000
    got = [np.frombuffer(x, "<u4").tolist() for x in model.lists.ids(words).to_pylist()]
    assert got == [library_ids(model, w) for w in words.to_pylist()]


def test_words_of_letters_in_a_column_are_not_worked_out_one_by_one(monkeypatch):
    model = wordwise(WORD_BPE)
    worked = []
    monkeypatch.setattr(model.known, "ids", lambda w, f=model._ids: worked.append(w) or f(w))
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abcdeéßя", k=9)) + rng.choice(["", ".", "!!"]) for _ in range(200)) + " É|7" for _ in range(20)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(20), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    out, = huffman_ids._tokenizer(WORD_BPE, 2)([batch])
    assert set(worked) <= {"É|7".encode(), "é|7".encode()}
    assert [np.frombuffer(x, "<u2").tolist() for x in out.column("ids").to_pylist()] == [
        library_ids(model, t) + [2] for t in texts]
