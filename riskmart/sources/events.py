"""Adapter: the driver's ``events`` table as staged transaction and identity tables.

``events(event_id, ts, user_id, event_type, value, props)`` stands in for the
raw transaction stream.  The mapping is fixed by the test fixtures (FIXTURES.md
section 3); columns the events cannot supply are typed NULLs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.schema import IDENTITY_TYPES, TRANSACTION_TYPES
from riskmart.sources.conform import conform

# Fixed values of the fixture mapping.
ORIGIN_EPOCH_SECONDS = 1704067200      # 2024-01-01 00:00:00 UTC: transaction_dt = 0
TRAIN_BEFORE_SECONDS = 1814400         # first 21 days are the train split
PRODUCT_BY_EVENT = {"purchase": "W", "view": "C", "click": "R", "signup": "H"}
PRODUCT_OTHER = "S"
NETWORK_BY_USER_MOD4 = {0: "visa", 1: "mastercard", 2: "discover"}
DOMAIN_BY_USER_MOD10 = {7: "mail.com", 3: "aim.com", 0: None, 1: "gmail.com", 2: "yahoo.com"}
DOMAIN_OTHER = "hotmail.com"


def _case(key, mapping: dict, default):
    expr = None
    for k, v in mapping.items():
        val = F.lit(v)
        expr = F.when(key == k, val) if expr is None else expr.when(key == k, val)
    return expr.otherwise(F.lit(default))


def events_to_transactions(events: DataFrame) -> DataFrame:
    """Staged transactions (train and test) from the event table."""
    # unix_timestamp of a timestamp without time zone does not depend on the session zone.
    dt = (F.unix_timestamp("ts") - F.lit(ORIGIN_EPOCH_SECONDS)).cast("bigint")
    k = F.get_json_object("props", "$.k").cast("int")
    ev = events.select("event_id", "user_id", "event_type", "value", dt.alias("dt"), k.alias("k"))

    user_mod10 = F.col("user_id") % 10
    is_train = F.col("dt") < TRAIN_BEFORE_SECONDS
    label = ((F.col("k") < 3)
             | ((F.col("k") < 20) & (user_mod10 == 7))
             | ((F.col("k") < 14) & (user_mod10 == 3)))
    staged = ev.select(
        F.when(is_train, "train").otherwise("test").alias("split"),
        F.col("event_id").alias("transaction_id"),
        F.when(is_train, label).alias("is_fraud"),
        F.col("dt").alias("transaction_dt"),
        F.col("value").alias("transaction_amt"),
        _case(F.col("event_type"), PRODUCT_BY_EVENT, PRODUCT_OTHER).alias("product_cd"),
        F.when(F.col("k") == 99, F.lit(None)).otherwise(F.col("user_id")).alias("card1"),
        _case(F.col("user_id") % 4, NETWORK_BY_USER_MOD4, None).alias("card4"),
        F.when(F.col("user_id") % 2 == 0, "credit").otherwise("debit").alias("card6"),
        _case(user_mod10, DOMAIN_BY_USER_MOD10, DOMAIN_OTHER).alias("p_emaildomain"),
        F.when(F.col("k") % 2 == 0, "gmail.com").alias("r_emaildomain"),
        F.when(F.col("k") < 30, F.col("k") % 7).otherwise(1).cast("double").alias("c1"),
    )
    return conform(staged, TRANSACTION_TYPES, keep_extra=False)


def events_to_identity(transactions: DataFrame) -> DataFrame:
    """Staged identity rows: every fourth transaction has one.

    This rule defines the identity table of the fixture (about a quarter of the
    transactions carry identity data, as in the source data); it is not a
    sample - every transaction is read and every qualifying one is kept.
    """
    tid = F.col("transaction_id")
    staged = transactions.where(tid % 4 == 0).select(
        "split", "transaction_id",
        F.when(tid % 8 == 0, "desktop").otherwise("mobile").alias("device_type"),
        F.when(tid % 12 == 0, F.lit(None)).otherwise(F.lit("device")).alias("device_info"),
    )
    return conform(staged, IDENTITY_TYPES, keep_extra=False)


def read_events(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def staged_from_events(spark, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    txn = events_to_transactions(read_events(spark, sf_dir))
    return txn, events_to_identity(txn)
