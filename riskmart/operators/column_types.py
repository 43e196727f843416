"""Types of columns that no layout lists, told from all of their text in one pass.

Every column counts how many of its values read as each type.  Counts add up, so files are
counted apart and their counts merged; the narrowest type that reads every value wins:
boolean, integer, double, date, time, else text.  A column without a value is text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Narrowest first: (type, SQL condition on the non-empty text {c}).  Dates read as times too,
# whole numbers as doubles; a boolean reads as nothing else.
TYPES = [
    ("boolean", "lower({c}) IN ('true', 'false')"),
    ("bigint", r"{c} RLIKE '^[+-]?[0-9]+$' AND try_cast({c} AS BIGINT) IS NOT NULL"),
    ("double", r"{c} RLIKE '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$'"),
    ("date", r"{c} RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$' AND try_cast({c} AS DATE) IS NOT NULL"),
    ("timestamp_ntz", r"{c} RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([ T][0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}([.][0-9]{{1,6}})?)?$'"
                      " AND try_cast({c} AS TIMESTAMP_NTZ) IS NOT NULL"),
]
Counts = dict[str, dict[str, int]]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_of(name: str) -> str:
    """SQL text of a raw column; empty text is NULL."""
    return f"nullif(CAST({quoted(name)} AS STRING), '')"


def type_counts(raw: DataFrame, columns: list[str]) -> Counts:
    """column -> how many values it has (``""``) and how many of them read as each type; one scan."""
    if not columns:
        return {}
    picks = []
    for k, name in enumerate(columns):
        c = text_of(name)
        picks.append(f"count({c}) AS n{k}")
        picks += [f"count_if({cond.format(c=c)}) AS t{k}_{j}" for j, (_, cond) in enumerate(TYPES)]
    row = raw.selectExpr(*picks).first()
    return {name: {"": row[f"n{k}"], **{t: row[f"t{k}_{j}"] for j, (t, _) in enumerate(TYPES)}}
            for k, name in enumerate(columns)}


def merged(*counts: Counts) -> Counts:
    out: Counts = {}
    for part in counts:
        for name, found in part.items():
            before = out.setdefault(name, {})
            for kind, n in found.items():
                before[kind] = before.get(kind, 0) + n
    return out


def narrowest(found: dict[str, int]) -> str:
    """The first type that reads every value; text where there is none, or no value."""
    return next((t for t, _ in TYPES if found[""] and found[t] == found[""]), "string")
