"""Intermediate layer: transactions left-joined to identity, plus derived features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.derived import amount_bucket, day_of_week, hour_of_day
from riskmart.operators.joins import is_small, shuffled_unless
from riskmart.schema import ENRICHED_IDENTITY_COLUMNS, ENRICHED_TRANSACTION_COLUMNS


def enrich(transactions: DataFrame, identity: DataFrame, hour_mode: str = "round") -> DataFrame:
    """``int_transactions_enriched``.

    Left join on ``transaction_id`` only (not on split); identity columns are
    NULL where no identity row exists.  Both inputs are large: this is a
    shuffle join on a unique key, so it has no hot keys to split.  Only an identity
    table that is counted to be small may be broadcast, as Spark sees fit.
    """
    t = transactions.alias("t")
    known = identity.select("transaction_id", *ENRICHED_IDENTITY_COLUMNS)
    i = shuffled_unless(is_small(known), known).alias("i")
    joined = t.join(i, F.col("t.transaction_id") == F.col("i.transaction_id"), "left")
    dt = F.col("t.transaction_dt")
    return joined.select(
        *[F.col(f"t.{c}").alias(c) for c in ENRICHED_TRANSACTION_COLUMNS],
        *[F.col(f"i.{c}").alias(c) for c in ENRICHED_IDENTITY_COLUMNS],
        hour_of_day(dt, hour_mode).alias("hour_of_day"),
        day_of_week(dt, hour_mode).alias("day_of_week"),
        amount_bucket(F.col("t.transaction_amt")).alias("amount_bucket"),
    )
