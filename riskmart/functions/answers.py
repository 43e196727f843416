"""Parsing and validating written review answers, as column expressions.

An answer is valid when, after stripping a Markdown fence, the text from the
first ``{`` to the last ``}`` is exactly one JSON object that

* holds the six answer keys (a JSON null value still counts as present),
* has ``risk_assessment`` in the four risk levels (case matters),
* has a ``confidence`` that reads as a number in [0, 1] (numeric text and
  booleans read as numbers; NULL or other text make the answer invalid).

Strictness: Spark's JSON readers accept trailing text after an object.  The
body is therefore wrapped in ``[...]`` and parsed as a variant: trailing junk
breaks the parse, and a second top-level value shows up as element ``$[1]``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskmart.schema import ANSWER_FIELDS, RISK_LEVELS

# Whitespace as Python's str.strip() sees it (ASCII, separators, Unicode spaces).
_WS = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_fence(text) -> Column:
    """Trim, then drop a leading ```` ``` ```` / ```` ```json ```` and a trailing ```` ``` ````."""
    t = F.regexp_replace(_col(text), rf"^{_WS}+|{_WS}+$", "")
    t = F.regexp_replace(t, rf"^```(?:json)?{_WS}*", "")
    return F.regexp_replace(t, rf"{_WS}*```$", "")


def json_body(text) -> Column:
    """Greedy first-``{``-to-last-``}`` span (across lines); NULL when there is none."""
    found = F.regexp_extract(strip_fence(text), r"(?s)\{.*\}", 0)
    return F.nullif(found, F.lit(""))


def wrap_json(body) -> Column:
    """``[body]`` parsed as a variant; NULL when it is not valid JSON (trailing junk included)."""
    return F.try_parse_json(F.concat(F.lit("["), _col(body), F.lit("]")))


def single_value(wrapped) -> Column:
    """The wrapped variant when it holds exactly one value (``{a},{b}`` has a ``$[1]``)."""
    w = _col(wrapped)
    return F.when(w.isNotNull() & F.variant_get(w, "$[1]", "variant").isNull(), w)


def field(v, name: str, typ: str = "string") -> Column:
    """Field ``name`` of the parsed answer object as ``typ`` (NULL if absent or not castable)."""
    return F.try_variant_get(_col(v), f"$[0].{name}", typ)


def parse_answers(df, raw: str = "raw_response", keep: list[str] | None = None):
    """``df`` with ``valid`` and the six answer fields (NULL unless valid).

    Done in separate projections - body, then variant and keys, then fields - so
    each regex and each JSON parse runs once per row (Spark does not inline an
    expensive expression into a projection that uses it several times).
    """
    keep = list(df.columns) if keep is None else keep
    step1 = df.select(*keep, json_body(F.col(raw)).alias("__body"))
    step2a = step1.select(*keep, wrap_json("__body").alias("__w"),
                          F.json_object_keys(F.col("__body")).alias("__keys"))
    step2 = step2a.select(*keep, single_value("__w").alias("__v"), "__keys")
    required = F.array(*[F.lit(k) for k in ANSWER_FIELDS])
    valid = F.coalesce(
        F.col("__v").isNotNull()
        & (F.size(F.array_except(required, F.col("__keys"))) == 0)
        & field("__v", "risk_assessment").isin(RISK_LEVELS)
        & field("__v", "confidence", "double").between(0.0, 1.0),
        F.lit(False))
    step3 = step2.select(*keep, "__v", valid.alias("valid"))
    fields = [F.when(F.col("valid"), field("__v", name, "double" if name == "confidence" else "string"))
              .alias(name) for name in ANSWER_FIELDS]
    return step3.select(*keep, "valid", *fields)
