"""Secret scan: fixed rules, and character Markov models for what they miss.

DataFrame functions only.  Three rules find assigned values, access keys and long
hexadecimal strings; a match's place is the length of what ``split`` leaves before
it.  Long tokens that touch no such span are scored by two first-order Markov models
over characters: one of random strings, trained on the values the rules found, one of
ordinary identifiers, trained on words of labelled (rule-free) documents.  A token is
a secret when its log-likelihood ratio exceeds ``log_odds``, the odds of an ordinary
token against a random one that are assumed beforehand; a fixed parameter, since the
sizes of two capped samples say nothing about them.

Counts have one row for each pair of 66 characters.  The samples are bounded:
``sample_docs`` documents of the smallest hash for ordinary words, ``sample_values``
values of the smallest hash for random strings.

Offsets are code points, ends exclusive.  Defined cases: a null or empty text has no
spans; a null id is passed on; rows that repeat are answered each; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import stash, whole_text

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{32,}"                   # a shorter run fails the rule, and no match starts inside a longer one
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CHAR = "[A-Za-z0-9+/_=-]"
BLOCK = 128                             # numbers that are summed one by one
STRETCH = 1 << 14
_FOUND = "array<struct<start:int,end:int,found:string>>"


@dataclass(frozen=True)
class Settings:
    token_chars: int = 20
    sample_docs: int = 2_000
    sample_values: int = 20_000
    uniform: float = 40.0               # pseudo-counts of a uniform next character, random strings
    smooth: float = 1.0                 # the same, ordinary identifiers
    log_odds: float = 10.0              # one random token among 22,000 ordinary ones


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value worked out once."""
    return F.transform(F.array(value), then)[0]


def _running(lengths: Column, at: Column) -> Column:
    """The sums before each of ``lengths``, from ``at`` on; its cost grows with their number squared."""
    start = F.struct(at.cast("int").alias("at"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(lengths, start, lambda s, n: F.struct(
        (s["at"] + n).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])


def running_sums(lengths: Column, block: int = BLOCK) -> Column:
    """The sum of all numbers before each one, in blocks, so that very many are no trouble."""
    def joined(parts: Column) -> Column:
        totals = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda s, n: s + n))
        return F.flatten(F.zip_with(parts, _running(totals, F.lit(0)), _running))

    def of(numbers: Column) -> Column:
        last = F.ceil(F.size(numbers) / F.lit(block)).cast("int") - 1
        blocks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(numbers, k * block + 1, F.lit(block)))
        return F.when(F.size(numbers) <= block, _running(numbers, F.lit(0))).otherwise(_let(blocks, joined))
    return _let(lengths, of)


def located(text: Column, pattern: str) -> Column:
    """Every match of ``pattern`` with its offsets; texts without one are passed over quickly."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    before = F.transform(F.split(text, pattern, -1), F.char_length)

    def spans(found: Column) -> Column:
        # a match starts behind all earlier text, between matches and of them
        lengths = F.zip_with(F.slice(before, 1, F.size(found)), found, lambda b, f: F.struct(
            b.alias("b"), F.char_length(f).alias("f")))
        return _let(lengths, lambda ls: F.zip_with(
            F.zip_with(ls, running_sums(F.transform(ls, lambda x: x["b"] + x["f"])), lambda x, at: F.struct(
                (at + x["b"]).alias("start"), (at + x["b"] + x["f"]).alias("end"))),
            found, lambda s, f: F.struct(s["start"].alias("start"), s["end"].alias("end"), f.alias("found"))))

    return F.when(text.rlike(pattern), _let(found, spans)).otherwise(F.array()).cast(_FOUND)


def apart(tokens: Column, base: Column, few: int = 4096) -> Column:
    """The tokens that touch no base span; many of both are compared within stretches of ``STRETCH`` code points."""
    touch = lambda b, t: (b["start"] < t["end"]) & (t["start"] < b["end"])
    stretch = F.lit(STRETCH)
    last = F.array_max(F.transform(base, lambda b: b["end"]))
    by_stretch = F.transform(F.sequence(F.lit(0), F.floor(last / stretch).cast("int")), lambda k: F.filter(
        base, lambda b: (b["start"] < (k + 1) * stretch) & (b["end"] > k * stretch)))
    near = lambda t: F.sequence(F.floor(t["start"] / stretch).cast("int"), F.floor(t["end"] / stretch).cast("int"))
    many = _let(by_stretch, lambda parts: F.filter(tokens, lambda t: ~F.exists(near(t), lambda k: F.coalesce(
        F.exists(F.get(parts, k), lambda b: touch(b, t)), F.lit(False)))))
    return F.when(F.size(tokens) * F.size(base).cast("bigint") <= few,
                  F.filter(tokens, lambda t: ~F.exists(base, lambda b: touch(b, t)))).otherwise(many)


def _of_kind(spans: Column, kind: str) -> Column:
    number = F.lit(KINDS.index(kind))
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), number.alias("kind"), s["end"].alias("end")))


def rules(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, base, values, tokens) of every row, written: fixed spans, their values, long tokens elsewhere."""
    text = F.col("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = rows.select(
        "doc_id", located(text, ASSIGN).alias("assign"), located(text, ACCESS).alias("access"),
        located(text, HEX).alias("hex"), located(text, f"{_CHAR}{{{settings.token_chars},}}+").alias("long"))
    value = lambda s: F.regexp_extract(s["found"], ASSIGN, 1)
    rows = rows.withColumns({
        "assign": F.filter("assign", lambda s: F.char_length(value(s)) >= 8),
        "access": F.filter("access", lambda s: F.char_length(s["found"]) >= 16)})
    base = F.array_sort(F.concat(*(_of_kind(F.col(k), k) for k in KINDS[:3])))
    values = F.array_distinct(F.concat(F.transform("assign", value), F.transform("access", lambda s: s["found"]),
                                       F.transform("hex", lambda s: s["found"])))
    rows = rows.select("doc_id", base.alias("base"), values.alias("values"), "long")
    return stash(rows.select("doc_id", "base", "values", apart(F.col("long"), F.col("base")).alias("tokens")), "secret-rules")


def pair_counts(words: DataFrame) -> DataFrame:
    """(pair, n) over the neighbouring characters of ``words`` (column word), for characters of ALPHABET."""
    place = F.sequence(F.lit(1), F.char_length("word") - 1)
    pairs = words.where(F.char_length("word") > 1).select(F.explode(
        F.transform(place, lambda i: F.substring("word", i, 2))).alias("pair"))
    return pairs.where(F.col("pair").rlike(f"^{_CHAR}{{2}}$")).groupBy("pair").agg(F.count("*").alias("n"))


def ratio_table(random: dict[str, int], ordinary: dict[str, int], settings: Settings) -> list[float]:
    """log P(next | before) under the random minus under the ordinary model, before-major over ALPHABET."""
    def logs(counts: dict[str, int], weight: float) -> list[float]:
        # a rare character before falls back on how common the next one is at all
        single = {b: sum(counts.get(a + b, 0) for a in ALPHABET) + weight / len(ALPHABET) for b in ALPHABET}
        every = sum(single.values())
        out = []
        for a in ALPHABET:
            row = [counts.get(a + b, 0) + weight * single[b] / every for b in ALPHABET]
            total = sum(row)
            out.extend(math.log(x / total) for x in row)
        return out
    return [r - o for r, o in zip(logs(random, settings.uniform), logs(ordinary, settings.smooth))]


def train(docs: DataFrame, found: DataFrame, settings: Settings = Settings()) -> tuple[list[float], float]:
    """The table of log ratios of character pairs, and the threshold a token's sum must exceed, whatever the samples' sizes."""
    values = found.select(F.explode("values").alias("word")).distinct()
    values = values.orderBy(F.xxhash64("word"), "word").limit(settings.sample_values)
    clean = found.where(F.size("base") == 0).where("doc_id is not null").select(F.col("doc_id").alias("id")).distinct()
    clean = F.broadcast(clean.orderBy(F.xxhash64("id"), "id").limit(settings.sample_docs))      # bounded by the limit
    words = (docs.select(F.col("doc_id").cast("long").alias("id"), whole_text().alias("text")).join(clean, "id")
             .select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z_-]{2,}"), F.lit(0))).alias("word")))
    counts = [{r["pair"]: r["n"] for r in pair_counts(sample).collect()}
              for sample in (stash(values, "secret-values"), stash(words, "secret-words"))]
    return ratio_table(*counts, settings), settings.log_odds


def scored(token: Column, table: list[float]) -> Column:
    """Sum of the log ratios of a token's character pairs."""
    values = F.split(F.lit(",".join(f"{v:.6f}" for v in table)), ",").cast("array<double>")
    place = lambda i: F.instr(F.lit(ALPHABET), F.substring(token, i, 1)) - 1
    return F.aggregate(F.sequence(F.lit(1), F.char_length(token) - 1), F.lit(0.0), lambda total, i: total + F.element_at(
        values, (place(i) * len(ALPHABET) + place(i + 1) + 1).cast("int")))


def scan(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov) of every row."""
    found = rules(docs, settings)
    table, threshold = train(docs, found, settings)
    added = F.filter("tokens", lambda t: scored(t["found"], table) > threshold)
    rows = found.select("doc_id", "base", _of_kind(added, "markov").alias("added"))
    names = F.array(*map(F.lit, KINDS))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("long")
    return rows.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in KINDS[:3]), F.sha2(joined("base"), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_markov"))
