"""Marts: the train-split fraud fact and the per-domain fraud mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.derived import percent, round_half_away
from riskmart.functions.exact import exact_avg
from riskmart.schema import FACT_COLUMNS

TRAIN = "train"


def fraud_fact(enriched: DataFrame) -> DataFrame:
    """``fct_fraud_analysis``: 16 columns of the train split."""
    return enriched.where(F.col("split") == TRAIN).select(*FACT_COLUMNS)


def email_domain_mart(fact: DataFrame, min_rows: int = 100) -> DataFrame:
    """``agg_fraud_by_email_domain``: per purchaser domain (NULL is its own group).

    Only domains with at least ``min_rows`` rows.  The aggregate is partial
    (map-side) before the shuffle, so a domain holding a large share of all
    rows costs one buffer row per task, not a hot partition.
    Files carry no order; use :func:`ordered_domain_mart` to read it sorted.
    """
    fraud_one = F.when(F.col("is_fraud"), 1).otherwise(0)
    n = F.count(F.lit(1))
    fraud = F.sum(fraud_one).cast("bigint")
    return (fact.groupBy(F.col("p_emaildomain").alias("domain"))
            .agg(n.alias("total_transactions"),
                 fraud.alias("fraud_count"),
                 round_half_away(percent(fraud, n), 4).alias("fraud_rate"),
                 round_half_away(exact_avg("transaction_amt"), 2).alias("avg_amount"),
                 round_half_away(exact_avg(F.when(F.col("is_fraud"), F.col("transaction_amt"))), 2)
                 .alias("avg_fraud_amount"))
            .where(F.col("total_transactions") >= min_rows))


def ordered_domain_mart(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.desc_nulls_last("fraud_rate"), F.asc_nulls_last("domain"))
