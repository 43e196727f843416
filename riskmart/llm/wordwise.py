"""Tokenize texts word by word with a public tokenizer, remembering distinct words."""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from riskmart.llm.common import Remembered

_STEM_ENDS = frozenset(bytes([c]) for c in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_TAIL = b".,!?;:&%*$#"          # no apostrophe, which may begin a piece of letters
_LONGEST = 200                  # bytes of a word merged here: the merges of one piece take time in its square
WORD_END = "</w>"


def _stays_letter(c: str) -> bool:
    """Whether a letter is letters only when normalised: else its mark goes with the signs after it."""
    return unicodedata.normalize("NFC", c).lower().isalpha()


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _plain_letters() -> str:
    """Letters up to the Cyrillic ones that stand for themselves when normalised and are lowered to one letter."""
    def plain(c: str) -> bool:
        return c.isalpha() and c.islower() and c.lower() == c and unicodedata.normalize("NFC", c) == c
    return "".join(c for c in map(chr, range(0x530)) if unicodedata.normalize("NFC", c) == c and plain(c.lower()))


_MARK = 1 << 31                 # no id: the end of a word in a list of words


def _ranks(path: str) -> dict[bytes, int]:
    """Ids of a BPE file's tokens by their bytes, a word end as a space, which no piece of a word holds."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    letters, ranks = _byte_letters(), {}
    for token, i in vocab.items():
        ends = token.endswith(WORD_END)
        shown = token[:-len(WORD_END)] if ends else token
        if shown and all(c in letters for c in shown):
            data = bytes(letters[c] for c in shown)
            if b" " not in data:
                ranks[data + b" " if ends else data] = i
    return ranks | {b" ": _MARK + 1, b"\n": _MARK}


class WordLists:
    """Ids of many distinct words in one call, by the same merges as ``LetterMerges``.

    For words of letters with, at most, signs of ``_TAIL`` after them; both parts are encoded
    apart.  A word end is a space here: the byte with the space after it is one symbol, as its
    id comes before every merge.
    """

    def __init__(self, path: str):
        import tiktoken
        self.letters, self.tail = _plain_letters(), _TAIL.decode()
        self.words = f"^[{self.letters}]+[{re.escape(self.tail)}]*$"
        self.pieces = tiktoken.Encoding("words", pat_str="[^ \\n]+ |\\n", mergeable_ranks=_ranks(path),
                                        special_tokens={})._core_bpe

    def holds(self, words: pa.Array) -> np.ndarray:
        """Which words can be encoded here."""
        found = pc.and_(pc.match_substring_regex(words, self.words), pc.less_equal(pc.binary_length(words), _LONGEST))
        return found.to_numpy(zero_copy_only=False)

    def ids(self, words: pa.Array) -> pa.LargeBinaryArray:
        """Ids of each word, as 32 bits each."""
        stems, tails = pc.utf8_rtrim(words, self.tail), pc.utf8_ltrim(words, self.letters)
        parts = pa.concat_arrays([pc.utf8_lower(stems), tails]).dictionary_encode()
        ids = self._parts(parts.dictionary).take(parts.indices)
        return pc.binary_join_element_wise(ids[:len(words)], ids[len(words):], pa.scalar(b"", pa.large_binary()))

    def _parts(self, parts: pa.Array) -> pa.LargeBinaryArray:
        one = pa.ListArray.from_arrays(pa.array([0, len(parts)], pa.int32()), parts.cast(pa.string()))
        listed = pc.binary_join(one, " \n")[0].as_py() + " \n" * bool(len(parts))
        found = np.frombuffer(self.pieces.encode_to_tiktoken_buffer(listed, set()), np.uint32)
        ends = np.flatnonzero(found == _MARK)
        if len(ends) != len(parts):
            raise ValueError(f"{len(ends)} words found in a list of {len(parts)}")
        offsets = np.concatenate([[0], ends - np.arange(len(ends))]) * 4
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(parts), [
            None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(found[found != _MARK])])


class LetterMerges:
    """The merges of a BPE file with word ends, for words of letters only, by the ranks of byte strings.

    ``tiktoken`` merges byte strings by rank, several times as fast as the file's own library,
    but knows no word ends.  A word of lower-case letters never has a byte below ``a``, so
    these codes are free: a byte that ends a word becomes one of them, and the byte with its
    word end is one symbol, as in the file.
    """

    def __init__(self, path: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, letters = model["vocab"], _byte_letters()
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if made != sorted(set(made)) or model["end_of_word_suffix"] != WORD_END or model["ignore_merges"]:
            raise ValueError("the ids of merged tokens must rise in the order of the merges, with word ends")
        inner = [b for b in range(256) if b >= ord("a")]
        finals = [b for b in inner if b <= ord("z") or 0x80 <= b < 0xC0]
        self.final = {b: bytes([k]) for k, b in enumerate(finals)}
        ranks = {}
        for token, i in vocab.items():
            ends = token.endswith(WORD_END)
            data = bytes(letters[c] for c in (token[:-len(WORD_END)] if ends else token))
            if data and min(data) >= ord("a") and (not ends or data[-1] in self.final):
                ranks[data[:-1] + self.final[data[-1]] if ends else data] = i
        self.encode_piece = tiktoken.Encoding("letters", pat_str="[^ ]+", mergeable_ranks=ranks,
                                              special_tokens={})._core_bpe.encode_single_piece

    def ids(self, word: bytes) -> list[int] | None:
        """Ids of a word; None where it is more than plain letters."""
        if len(word) > _LONGEST:
            return None
        if word.isalpha() and word.islower():           # of bytes: plain ASCII letters
            return self.encode_piece(word[:-1] + self.final[word[-1]])
        text = unicodedata.normalize("NFC", word.decode("utf-8", "replace"))
        if not text.isalpha() or not text.islower():
            return None                                 # capitals: the library lowers letter by letter
        word = text.encode()
        end = self.final.get(word[-1])
        if end is None or min(word) < 97:
            return None
        return self.encode_piece(word[:-1] + end)


class LearnedWords(Remembered):
    """Remembered words that look up what they do not know: a lookup that finds a word costs one step in C."""

    def __init__(self, limit: int, ids: Callable[[bytes], bytes]):
        super().__init__(limit)
        self.ids = ids

    def __missing__(self, word: bytes) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self.ids(word)
        self[word] = found
        return found


class WordwiseBpe:
    """Ids of whole texts under a ``tokenizers`` file whose pre-tokens never span white space.

    Such a tokenizer drops white space and splits at it, so a text's ids are those
    of its white-space separated words in turn.  Only ASCII white space is split at;
    a word holding other white space is passed to the library as it is.  The tokenizer
    lower-cases, so ASCII capitals need not be told apart, but for its special tokens;
    a letter or digit and the full stops, commas and other signs of ``_TAIL`` that end
    a word after it are never one piece.  A distinct word is encoded once while it is remembered: words of letters by
    ``LetterMerges``, all others by the library.  Of a column of texts, the distinct words
    that ``WordLists`` holds are encoded in one call and not remembered.
    """

    def __init__(self, path: str, limit: int = 150_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.letters, self.lists = Tokenizer.from_file(path), LetterMerges(path), WordLists(path)
        self.known = LearnedWords(limit, self._ids)

    def _ids(self, word: bytes) -> bytes:
        """Ids of a word that is not remembered."""
        if not word.isalpha():
            stem = word.rstrip(_TAIL)
            if stem != word and (stem[-1:] in _STEM_ENDS or _stays_letter(stem.decode("utf-8", "replace")[-1:])):
                return self.known[stem] + self.known[word[len(stem):]]
        ids = self.letters.ids(word)
        if ids is None:
            # the batch call, as it tells no offsets
            ids = self.tokenizer.encode_batch_fast([word.decode("utf-8", "replace")], add_special_tokens=False)[0].ids
        return array("I", ids).tobytes()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        self.known.make_room()
        known = self.known.__getitem__          # learns what it does not know
        return [b"".join(map(known, (t if b"<|" in t else t.lower()).split())) for t in texts]

    def encode_column(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in turn, and where each text's ids begin in them, with the end of the last.

        As ``encode``, but words are split and told apart in Arrow: each distinct word is looked at once.
        """
        texts = pc.fill_null(texts, "")
        texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary
        listed = self.lists.holds(distinct)
        self.known.make_room()
        others = distinct.filter(pa.array(~listed)).cast(pa.large_binary()).to_pylist()
        ids = pa.concat_arrays([self.lists.ids(distinct.filter(pa.array(listed))),
                                pa.array([self.known[w] if w else b"" for w in others], pa.large_binary())])
        place = np.where(listed, np.cumsum(listed) - 1, listed.sum() + np.cumsum(~listed) - 1)
        every = ids.take(pa.array(place[words.indices.to_numpy()], pa.int64()))
        ends = np.frombuffer(every.buffers()[1], np.int64, len(every) + 1) // 4
        cuts = ends[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return np.frombuffer(every.buffers()[2] or b"", "<u4", int(ends[-1])), cuts


@lru_cache(1)
def wordwise(path: str) -> WordwiseBpe:
    """One encoder for each Python worker."""
    return WordwiseBpe(path)
