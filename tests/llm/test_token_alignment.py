"""Alignment of two tokenizers against the libraries and a plain merge of their ends."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from riskmart.llm import token_alignment
from riskmart.llm.common import table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", "a  b", " a", "a ", "a\n  b", "x \n y ", "x\n\n", "\n", " \t", "<|endoftext|> <s> </s>",
       "é  x", "a\x1c  b", "a  b", "a   b", "　", "don't  I'll\r\n x", "日本語 テスト  。", "▁x", "a ▁", "ﬁ ½",
       "\x00 a", "🙂🙂 a", "a", "a", "</s>[INST] ok [/INST]", "x" * 3000, "a b " * 3000, "      z"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    letters = token_alignment._byte_letters()
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    a_bytes = lambda i: bytes(letters[c] for c in a.id_to_token(i))

    def b_bytes(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
    return (lambda t: [(i, a_bytes(i)) for i in a.encode(" " + t, add_special_tokens=False).ids],
            lambda t: [(i, b_bytes(i)) for i in b.encode(t)])


def plain(texts, libraries):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_overlaps) for each text."""
    rows, links = [], []
    for t in texts:
        sides = [f(t) if t else [] for f in libraries]
        if any(b"".join(x for _, x in s) != b" " + (t or "").encode() for s in sides):
            sides = [[], []]
        ends = [np.cumsum([len(x) for _, x in s]).tolist() for s in sides]
        at = [dict(zip(e, (i for i, _ in s))) for e, s in zip(ends, sides)]
        both = sorted(set(ends[0]) & set(ends[1]))
        groups, low = [], 0
        for high in both:
            groups.append("|".join(",".join(str(i) for e, (i, _) in zip(es, s) if low < e <= high)
                                   for es, s in zip(ends, sides)))
            low = high
        rows.append((len(sides[0]), len(sides[1]), len(groups), ";".join(groups), len(set(ends[0]) | set(ends[1]))))
        links.append([(at[0][e], at[1][e]) for e in both])
    count = Counter(p for ps in links for p in ps)
    top = Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return [(na, nb, ng, ng, sum(count[p] == top[p[1]] for p in ps), sum(count[p] for p in ps),
             hashlib.sha256(g.encode()).hexdigest() if na else "", no)
            for (na, nb, ng, g, no), ps in zip(rows, links)]


def of(spark, texts, **options):
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, row string, n_a int")
    found = token_alignment.digests(frame.repartition(3), A, B, **options).collect()
    return [tuple(r)[1:] for r in sorted(found)]


def test_overlaps_of_any_piece_size():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randrange(1, 60)
        a, b = (np.array(sorted({*rng.sample(range(1, n + 1), rng.randrange(0, n)), n})) for _ in range(2))
        plainly = [((a < x).sum(), (b < x).sum(), x, x in a and x in b) for x in sorted({*a.tolist(), *b.tolist()})]
        for piece in (1, 2, 3, 7, 64):
            assert plainly == list(zip(*(x.tolist() for x in token_alignment.overlaps(a, b, piece))))
    assert all(len(x) == 0 for x in token_alignment.overlaps(np.zeros(0, int), np.zeros(0, int)))


def test_odd_texts_equal_plain_version(spark, libraries):
    expected = plain(ODD, libraries)
    assert of(spark, ODD) == expected
    assert of(spark, ODD, broadcast_pairs=0) == expected            # the shuffle join
    assert of(spark, []) == []


def test_documents_equal_plain_version(spark, libraries):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    expected = dict(zip(sorted(texts), plain([texts[i] for i in sorted(texts)], libraries)))
    found = {r["doc_id"]: tuple(r)[1:] for r in token_alignment.digests(docs, A, B).collect()}
    assert found == expected


def test_spans_cover_the_text(spark):
    text = "Aligned tokens, naïvely.\nAnd more  of them"
    frame = spark.createDataFrame([(1, text), (None, text), (2, "")], "doc_id long, text string")
    for r in token_alignment.aligned(frame, A, B, spans=True, piece=4).collect():
        size = len(text.encode()) + 1 if r["n_a"] else 0
        assert (r["over_end"] or [0])[-1] == size
        assert len(r["over_a"]) == len(r["over_b"]) == r["n_overlaps"]
        assert sorted(set(r["over_a"])) == list(range(r["n_a"])) and sorted(set(r["over_b"])) == list(range(r["n_b"]))
