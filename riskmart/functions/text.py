"""Text formatting expressions for the review prompts.

Numbers are formatted with ``format_number(x, '0.00')``: no grouping commas,
and ties resolved on the exact binary value like Python's ``:.2f``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed(x, decimals: int) -> Column:
    """``x`` with a fixed number of decimals (``f"{x:.Nf}"``); NULL stays NULL."""
    pattern = "0" if decimals == 0 else "0." + "0" * decimals
    return F.call_function("format_number", _col(x), F.lit(pattern))


def money(x) -> Column:
    """``$12.30``; ``N/A`` when the amount is missing."""
    return F.coalesce(F.concat(F.lit("$"), fixed(x, 2)), F.lit("N/A"))


def or_na(x) -> Column:
    """Text or ``N/A`` when NULL or empty (Python's ``x or 'N/A'``)."""
    c = _col(x).cast("string")
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("N/A"))


def as_text(x, null_text: str = "None") -> Column:
    """Plain ``str(x)``-style rendering with a fixed text for NULL."""
    return F.coalesce(_col(x).cast("string"), F.lit(null_text))


def yes_no(flag) -> Column:
    return F.when(_col(flag), "yes").otherwise("no")


def hour_text(hour) -> Column:
    return F.concat(as_text(hour), F.lit(":00"))


def fill_template(template: str, fields: dict[str, Column]) -> Column:
    """Fill ``{name}`` placeholders of ``template`` with column values (one concat)."""
    parts: list[Column] = []
    rest = template
    while rest:
        start = rest.find("{")
        if start < 0:
            parts.append(F.lit(rest))
            break
        end = rest.index("}", start)
        if start:
            parts.append(F.lit(rest[:start]))
        parts.append(fields[rest[start + 1:end]].cast("string"))
        rest = rest[end + 1:]
    return F.concat(*parts)
