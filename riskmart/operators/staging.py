"""Staging: raw transaction / identity rows -> typed, split-tagged tables.

Raw files arrive with text columns named as in their header.  One projection serves
both inputs: a rule table says how each staged column is made from its raw text, the
``split`` literal and (for transactions) the label come first, and columns that no layout
lists get the type given for them, text where none is.  Train and test are then unioned
by name (no dedup).

Empty text is NULL.  Key, label, time and amount are strict.  A strict whole number is
text of exactly that value (``12``, ``12.0``): it is read as a decimal, so no digit is
rounded away.  What a strict column cannot read either fails the job with the value in the
message, or (``checked_*``) goes to the rejects with its reason, as records do that have
more or fewer fields than their header.  Other typed columns are tolerant: such text
becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.columns import staged_names
from riskmart.operators.column_types import quoted, text_of
from riskmart.schema import CARD_INT_COLUMNS, EMAIL_COLUMNS, IDENTITY_TYPES, TRANSACTION_TYPES
from riskmart.sources.conform import conform
from riskmart.sources.csv import FILE, RECORD

LABEL_COLUMN = "isFraud"
STRICT = {"transaction_id", "transaction_dt", "transaction_amt", "is_fraud"}
REASON = "__reason"
REJECT_COLUMNS = ["split", "file", "reason", "record"]

# SQL text of a staged column from its raw text {c} (one call into the JVM for hundreds of columns)
_WHOLE = "coalesce(try_cast({c} AS {t}), try_cast(rint(try_cast({c} AS DOUBLE)) AS {t}))"
_RULES = {
    "email": "lower({c})",
    "string": "{c}",
    "int": _WHOLE,                       # "404.0" -> 404 through a double
    "bigint": _WHOLE,
    # "1", "1.0", "true", "True"
    "boolean": "coalesce(try_cast({c} AS BOOLEAN), try_cast({c} AS DOUBLE) <> 0)",
}
_PLAIN = "try_cast({c} AS {t})"
# A whole number written with or without a fraction of zeros, never rounded.
_EXACT_WHOLE = ("coalesce(try_cast({c} AS {t}), CASE WHEN try_cast({c} AS DECIMAL(38,10)) % 1 = 0 "
                "THEN try_cast(try_cast({c} AS DECIMAL(38,10)) AS {t}) END)")


def _value(c: str, name: str, kind: str) -> str:
    rule = _EXACT_WHOLE if name in STRICT and kind in ("int", "bigint") else _RULES.get(kind, _PLAIN)
    return rule.format(c=c, t=kind)


def _column(raw: str, name: str, kind: str, fails: bool) -> str:
    c, value = text_of(raw), _value(text_of(raw), name, kind)
    if fails and name in STRICT:
        bad = f"raise_error(concat('{name} holds ', {c}))"
        value = f"CASE WHEN {c} IS NOT NULL AND ({value}) IS NULL THEN {bad} ELSE {value} END"
    return f"{value} AS {quoted(name)}"


def _reason(kinds: dict[str, tuple[str, str]]) -> str:
    """SQL text of why a record is rejected, NULL where it is not; ``kinds``: raw -> (staged name, kind)."""
    wrong = [f"CASE WHEN {quoted(RECORD)} IS NOT NULL THEN 'more or fewer fields than the header' END"]
    for raw, (name, kind) in kinds.items():
        if name in STRICT:
            c = text_of(raw)
            wrong.append(f"CASE WHEN {quoted(RECORD)} IS NULL AND {c} IS NOT NULL AND ({_value(c, name, kind)}) IS NULL "
                         f"THEN concat('{name} holds ', {c}) END")
    return f"nullif(concat_ws('; ', {', '.join(wrong)}), '') AS {REASON}"


def _staged(raw: DataFrame, split: str, types: dict[str, str], special: dict[str, str],
            labelled: bool | None, more_types: dict[str, str] | None, checked: bool) -> DataFrame:
    """One raw file as staged columns.

    ``special``: kinds of raw columns that go before their type; ``labelled``: whether the
    label is read (None: the table has none); ``more_types``: of staged names no layout lists.
    """
    columns = [c for c in raw.columns if c not in (RECORD, FILE)]
    names = staged_names(columns)
    extra = more_types or {}
    kinds = {c: (names[c], special.get(c) or types.get(names[c]) or extra.get(names[c]) or "string") for c in columns}
    picks = [f"'{split}' AS split"]
    if labelled is not None:
        if labelled and LABEL_COLUMN in columns:
            picks.append(_column(LABEL_COLUMN, "is_fraud", "boolean", not checked))
            kinds[LABEL_COLUMN] = ("is_fraud", "boolean")
        else:
            picks.append("CAST(NULL AS BOOLEAN) AS is_fraud")
            kinds.pop(LABEL_COLUMN, None)
        columns = [c for c in columns if c != LABEL_COLUMN]
    picks += [_column(c, *kinds[c], not checked) for c in columns]
    if checked:
        whole = f"to_csv(struct({', '.join(quoted(c) for c in raw.columns if c not in (RECORD, FILE))}))"
        picks += [_reason(kinds), f"coalesce({quoted(RECORD)}, {whole}) AS {RECORD}", FILE]
    return raw.selectExpr(*picks)


def _transactions(raw: DataFrame, split: str, labelled: bool, more_types=None, checked: bool = False) -> DataFrame:
    special = dict.fromkeys(EMAIL_COLUMNS, "email") | dict.fromkeys(CARD_INT_COLUMNS, "int")
    return _staged(raw, split, TRANSACTION_TYPES, special, labelled, more_types, checked)


def _identity(raw: DataFrame, split: str, more_types=None, checked: bool = False) -> DataFrame:
    return _staged(raw, split, IDENTITY_TYPES, {}, None, more_types, checked)


def _union(parts: list[DataFrame], types: dict[str, str]) -> DataFrame:
    out, *more = (conform(p, types) for p in parts)
    for p in more:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def stage_transactions(train_raw: DataFrame, test_raw: DataFrame | None = None) -> DataFrame:
    """``stg_transactions``: train (labelled) and test (label NULL) in one table."""
    test = [] if test_raw is None else [_transactions(test_raw, "test", False)]
    return _union([_transactions(train_raw, "train", True), *test], TRANSACTION_TYPES)


def stage_identity(train_raw: DataFrame, test_raw: DataFrame | None = None) -> DataFrame:
    """``stg_identity``: train and test identity rows in one table."""
    test = [] if test_raw is None else [_identity(test_raw, "test")]
    return _union([_identity(train_raw, "train"), *test], IDENTITY_TYPES)


# -- with rejects ------------------------------------------------------------------------------

def unlisted(raw: DataFrame, types: dict[str, str]) -> list[str]:
    """Raw columns whose staged name no layout lists."""
    names = staged_names(c for c in raw.columns if c not in (RECORD, FILE))
    return [c for c, name in names.items() if name not in types and c != LABEL_COLUMN]


def checked_transactions(train_raw: DataFrame, test_raw: DataFrame, more_types: dict[str, str] | None = None) -> DataFrame:
    """Staged transactions of raw rows read with their records, each with the reason it is rejected for (or NULL)."""
    return _union([_transactions(train_raw, "train", True, more_types, True),
                   _transactions(test_raw, "test", False, more_types, True)], TRANSACTION_TYPES)


def checked_identity(train_raw: DataFrame, test_raw: DataFrame, more_types: dict[str, str] | None = None) -> DataFrame:
    """Staged identity rows, as :func:`checked_transactions`."""
    return _union([_identity(train_raw, "train", more_types, True), _identity(test_raw, "test", more_types, True)],
                  IDENTITY_TYPES)


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNull()).drop(REASON, RECORD, FILE)


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNotNull()).select(
        "split", F.col(FILE).alias("file"), F.col(REASON).alias("reason"), F.col(RECORD).alias("record"))
