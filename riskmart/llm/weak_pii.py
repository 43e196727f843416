"""Personal data by weak supervision.

Fixed rules find e-mail addresses, IP addresses, card and phone numbers; those spans
always stay.  A wider net takes further candidates (digit groups, bank account
numbers, written-out addresses, names after a form of address or from a list).  Regex, gazetteer
and context labelers vote on every span, the fixed ones included; expectation
maximisation over the counts of all vote patterns estimates how reliable each labeler
is and how likely each pattern is personal data; a logistic regression on the span's
own features, fitted to those probabilities, is the final classifier.  Candidates it
accepts that do not overlap a fixed span are added.

The driver gets one row for each vote pattern (at most 3^9) and each feature pattern
(at most 2^12); documents and spans stay with Spark.

Offsets are code points, ends exclusive.  Defined cases: a null or empty text has no
spans; a null id is passed on; rows that repeat are answered each; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import stash, whole_text

KINDS = ("email", "ip", "card", "phone")
ADDED = ("iban", "number", "address", "name")

# Each finds what the plain pattern finds leftmost and without overlap, in one pass: a
# run of digits is taken whole, so no start inside it is tried again.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++\.[0-9]++\.[0-9]++)?+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every fixed rule's matches, sorted."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, 0, m.end()))
        last = m.end() if m else at + 1               # a local part never reaches over an @
        at = text.find("@", last)
    for m in _IP.finditer(text):
        if "." in m[0] and all(int(p.lstrip("0")[:4] or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# -- candidates, votes, features ------------------------------------------------------------

GIVEN_NAMES = frozenset("""James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara
Richard Susan Joseph Jessica Thomas Sarah Charles Karen Hans Anna Peter Maria Jean Pierre Marie Claire Juan Carmen
Luis Sofia Carlos Lucia""".split())
FORMS = r"(?:Mr|Mrs|Ms|Dr|Herr|Frau|Monsieur|Madame|Señor|Señora)\.?"
_CANDIDATES = (
    (4, re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])")),
    (5, re.compile(r"(?<![A-Za-z0-9])\(?[0-9](?:[ ().-]{0,2}[0-9]){6,}+(?![A-Za-z0-9])")),
    (6, re.compile(r"[A-Za-z0-9_-]{1,64} ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{1,64}(?: ?(?:[\[(](?:dot|DOT)[\])]|\.) ?[A-Za-z0-9-]{1,64}){1,4}")),
    (7, re.compile(FORMS + r" [A-ZÀ-Þ][\w'-]{1,30}(?: [A-ZÀ-Þ][\w'-]{1,30})?")),
    (7, re.compile(r"(?<!\w)(?:" + "|".join(sorted(GIVEN_NAMES)) + r") [A-ZÀ-Þ][\w'-]{1,30}")),
)
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
_LOCAL_PHONE = re.compile(r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}")
_DATE = re.compile(r"[0-9]{4}[-.][0-9]{2}[-.][0-9]{2}|[0-9]{1,2}[-.][0-9]{1,2}[-.][0-9]{4}")
_FOR = re.compile(r"(?i)\b(?:phone|tel|telephone|call|mobile|fax|contact|mail|e-?mail|write to|ssn|social security"
                  r"|account|iban|card|passport|born|name|lives|reach)\b")
_AGAINST = re.compile(r"(?i)\b(?:order|version|isbn|page|figure|total|price|invoice|ref|item|no\.|number of|id|sku)\b")
LABELERS = ("rule", "iban check", "known shape", "luhn", "spread digits", "date", "gazetteer", "context for",
            "context against")
FEATURES = 12


def iban_valid(text: str) -> bool:
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def votes(text: str, kind: int, start: int, end: int) -> list[int]:
    """Each labeler's vote: 1 personal data, -1 not, 0 no opinion."""
    span, digits = text[start:end], _digits(text[start:end][:200])
    numeric = kind in (2, 3, 5)
    before = text[max(0, start - 40): start]
    return [
        1 if kind < len(KINDS) else 0,
        (1 if iban_valid(span) else -1) if kind == 4 else 0,
        0 if not numeric else 1 if _SSN.fullmatch(span) or _LOCAL_PHONE.fullmatch(span) else -1 if kind == 5 else 0,
        (1 if luhn(digits) else -1) if numeric and 14 <= len(digits) <= 19 and kind != 3 else 0,
        -1 if numeric and (len(digits) > 19 or len(set(digits)) <= 2) else 0,
        -1 if numeric and _DATE.fullmatch(span) else 0,
        (1 if set(re.findall(r"\w+", span)) & GIVEN_NAMES else 0) if kind == 7 else 0,
        1 if _FOR.search(before) else 0,
        -1 if _AGAINST.search(before) else 0,
    ]


def features(text: str, kind: int, start: int, end: int) -> int:
    """The span's own look, as bits."""
    span, digits = text[start:end][:200], _digits(text[start:end][:200])
    n, before = len(digits), text[max(0, start - 40): start]
    bits = [kind == 0 or kind == 6, kind == 1, kind in (2, 5) and 14 <= n <= 19, kind in (2, 5) and luhn(digits or "1"),
            kind == 3, kind == 4, kind == 7, bool(_SSN.fullmatch(span)), bool(_LOCAL_PHONE.fullmatch(span.strip())),
            kind == 4 and iban_valid(span), bool(_FOR.search(before)), bool(_AGAINST.search(before))]
    return sum(1 << i for i, b in enumerate(bits) if b)


def _candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of spans of the wider net that overlap neither a fixed span nor each other."""
    taken, out = bytearray(len(text)), []
    for s, _, e in base:
        taken[s:e] = b"\1" * (e - s)
    for kind, pattern in _CANDIDATES:
        if kind in (4, 5) and not any(c in text for c in "0123456789"):
            continue
        for m in pattern.finditer(text):
            if 1 not in taken[m.start(): m.end()]:
                taken[m.start(): m.end()] = b"\1" * (m.end() - m.start())
                out.append((m.start(), kind, m.end()))
    return sorted(out)


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("votes", pa.int32()),
                   ("bits", pa.int32())])
_FOUND = "doc_id long, spans array<struct<start:long,kind:int,end:long,votes:int,bits:int>>"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text in batch.column("text"):
            text = text.as_py()
            base = base_spans(text)
            rows = []
            for s, k, e in sorted(base + _candidates(text, base)):
                code = sum((v + 1) * 3 ** i for i, v in enumerate(votes(text, k, s, e)))
                rows.append({"start": s, "kind": k, "end": e, "votes": code, "bits": features(text, k, s, e)})
            out.append(rows)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.list_(_SPAN))], ["doc_id", "spans"])


# -- the models ---------------------------------------------------------------------------------

def vote_matrix(codes: np.ndarray) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(len(LABELERS)) % 3 - 1


def em(pattern: np.ndarray, count: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Probability of personal data for each vote pattern.

    Every labeler that votes is right with a chance of its own for either truth; a labeler
    without a vote says nothing.  Starts from labelers right four times in five, and keeps ten
    such rows a labeler in the counts; the truths count as equally common, since the net, not
    the corpus, decides how many spans of either there are.
    """
    right = np.full((2, pattern.shape[1]), 0.8)          # [truth, labeler]
    p = np.full(len(pattern), 0.5)
    for _ in range(rounds):
        yes, no = np.zeros(len(pattern)), np.zeros(len(pattern))
        for j in range(pattern.shape[1]):
            v = pattern[:, j]
            yes += np.where(v > 0, np.log(right[1, j]), np.where(v < 0, np.log(1 - right[1, j]), 0))
            no += np.where(v < 0, np.log(right[0, j]), np.where(v > 0, np.log(1 - right[0, j]), 0))
        new = 1 / (1 + np.exp(np.clip(no - yes, -50, 50)))
        for truth, weight in ((1, new * count), (0, (1 - new) * count)):
            said = pattern != 0
            agree = (pattern > 0) if truth else (pattern < 0)
            right[truth] = ((weight[:, None] * agree).sum(0) + 8) / ((weight[:, None] * said).sum(0) + 10)
        right = np.clip(right, 0.5, 0.999)               # a labeler may be useless, never misleading
        if np.abs(new - p).max(initial=0) < 1e-9:
            break
        p = new
    return p


def logistic(x: np.ndarray, p: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Coefficients (constant first) of a logistic regression on probabilities, by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    beta, penalty = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    for _ in range(rounds):
        fit = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (p - fit)) - ridge * beta
        curve = (x * (weight * fit * (1 - fit))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, slope)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def feature_matrix(bits: np.ndarray) -> np.ndarray:
    return (bits[:, None] >> np.arange(FEATURES) & 1).astype(np.float64)


def fit(found: DataFrame) -> set[int]:
    """The feature patterns that the final classifier accepts, of those that occur."""
    spans = found.select(F.explode("spans").alias("s")).select("s.votes", "s.bits")
    both = stash(spans.groupBy("votes", "bits").agg(F.count("*").alias("n")), "pii-patterns")
    seen = both.groupBy("votes").agg(F.sum("n").alias("n")).collect()              # at most 3^9 rows
    if not seen:
        return set()
    codes, n = np.array([r["votes"] for r in seen]), np.array([r["n"] for r in seen], np.float64)
    p = em(vote_matrix(codes), n)
    table = found.sparkSession.createDataFrame([(int(c), float(v)) for c, v in zip(codes, p)], "votes int, p double")
    rows = both.join(F.broadcast(table), "votes").groupBy("bits").agg(             # at most 2^12 rows
        F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("p")) / F.sum("n")).alias("p")).collect()
    x = feature_matrix(np.array([r["bits"] for r in rows]))
    beta = logistic(x, np.array([r["p"] for r in rows]), np.array([r["n"] for r in rows], np.float64))
    score = beta[0] + x @ beta[1:]
    return {r["bits"] for r, s in zip(rows, score) if s >= 0}


_NAMES = (*KINDS, *ADDED)


def _writer(accepted: set[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added")}
            for spans in batch.column("spans").to_pylist():
                base = [s for s in spans if s["kind"] < len(KINDS)]
                every = [s for s in spans if s["kind"] < len(KINDS) or s["bits"] in accepted]
                text = [",".join(f"{_NAMES[s['kind']]}:{s['start']}:{s['end']}" for s in part) for part in (base, every)]
                counts = [sum(s["kind"] == k for s in base) for k in range(len(KINDS))]
                for k, v in zip(out, (*counts, hashlib.sha256(text[0].encode()).hexdigest(), text[1],
                                      len(every) - len(base))):
                    out[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(v, pa.string() if k in ("base_sha256", "spans") else pa.int64())
                                           for k, v in out.items())], ["doc_id", *out])
    return run


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) with every fixed span and candidate, its votes and features, written."""
    return stash(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(
        _find, _FOUND), "pii-spans")


def classified(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every row."""
    found = spans(docs)
    return found.mapInArrow(_writer(fit(found)), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                                 "base_sha256 string, spans string, n_added long")
