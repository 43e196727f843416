"""Bring a frame to a declared layout: typed NULLs for absent columns, fixed order."""

from __future__ import annotations

from pyspark.sql import DataFrame


def conform(df: DataFrame, types: dict[str, str], keep_extra: bool = True) -> DataFrame:
    """Select ``types`` in order (absent ones as typed NULLs), then any extra columns.

    Built as one ``selectExpr`` of SQL snippets: for hundreds of columns this
    is a single call into the JVM instead of several per column.
    """
    present = set(df.columns)
    exprs = [f"CAST(`{c}` AS {t}) AS `{c}`" if c in present else f"CAST(NULL AS {t}) AS `{c}`"
             for c, t in types.items()]
    if keep_extra:
        exprs += [f"`{c}`" for c in df.columns if c not in types]
    return df.selectExpr(*exprs)
