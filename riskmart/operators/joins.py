"""Join helpers that keep broadcasts behind a size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when it is counted to have at most so many rows and bytes.
DEFAULT_BROADCAST_ROWS = 100_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def _width(df: DataFrame):
    """Bytes of a row's values: texts and binaries by their length, others by a fixed size."""
    known = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) if t in ("string", "binary") else
             F.octet_length(F.to_json(F.struct(F.col(f"`{c}`")))) if t.startswith(("array", "map", "struct")) else F.lit(8)
             for c, t in df.dtypes]
    return sum(known, F.lit(16)).cast("bigint")


def is_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Whether ``df`` is counted to have at most ``max_rows`` rows of ``max_bytes`` bytes in all."""
    seen = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.sum(_width(df)).alias("bytes")).first()
    return seen["rows"] <= max_rows and (seen["bytes"] or 0) <= max_bytes


def broadcast_when(small: bool, df: DataFrame) -> DataFrame:
    """Mark ``df`` for broadcast where its rows are known to be few; else leave it to a shuffle join."""
    return F.broadcast(df) if small else df


def shuffled_unless(small: bool, df: DataFrame) -> DataFrame:
    """Have both sides of a join with ``df`` shuffled, unless its rows are known to be few.

    For a side read from files: Spark judges it by the files' size, and a table that compresses
    well is many times larger as the hash table that every task then holds.
    """
    return df if small else df.hint("merge")


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if a count proves it small; else leave it to a shuffle join.

    Meant for sides that are already reduced (an aggregate table, a filtered
    mart); counting those is cheap.  Beyond the bound the plain frame is
    returned and Spark plans a sort-merge join, which adaptive execution can
    still turn into a broadcast at run time or split when a key is skewed.
    """
    return broadcast_when(is_small(df, max_rows), df)
