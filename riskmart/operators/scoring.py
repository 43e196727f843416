"""Rule-based scoring: four flags of 25 points each, over every split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.derived import fraud_flag, percent
from riskmart.functions.exact import exact_avg
from riskmart.operators.joins import broadcast_if_small
from riskmart.schema import FLAG_COLUMNS, SCORING_COLUMNS


def card_average(enriched: DataFrame) -> DataFrame:
    """Average amount per ``card1`` over all splits (NULL card is a group too), exact in any row order."""
    return enriched.groupBy("card1").agg(exact_avg("transaction_amt").alias("avg_card1_amt"))


def high_risk_domains(domain_mart: DataFrame, rate_over: float = 10.0) -> DataFrame:
    """Domains of the mart whose fraud rate (percent) is above ``rate_over``."""
    return domain_mart.where(F.col("fraud_rate") > rate_over).select("domain")


def score(enriched: DataFrame, domain_mart: DataFrame, *, c1_over: float = 3,
          amount_factor: float = 3, hours: tuple[int, int] = (1, 5),
          rate_over: float = 10.0, points: int = 25, averages: DataFrame | None = None) -> DataFrame:
    """``rule_based_scoring``.

    * card average: a left join on ``card1`` with ``averages`` (``card_average`` when
      not given).  Given as a written table, both sides of the join are plain shuffles,
      so adaptive execution splits a hot card's (or NULL's) partition; an aggregate
      planned in place sits between its shuffle and the join and rules that out.
    * risky domains: a membership test (NULL domain never matches), done as a
      left join against the few risky domains, broadcast behind a row check.
    """
    avg = card_average(enriched) if averages is None else averages
    risky = high_risk_domains(domain_mart, rate_over).where(F.col("domain").isNotNull())
    risky = broadcast_if_small(risky.withColumn("_risky", F.lit(1)))

    e = enriched.alias("e")
    scored = (e.join(avg.alias("ca"), F.col("e.card1") == F.col("ca.card1"), "left")
              .join(risky.alias("hr"), F.col("e.p_emaildomain") == F.col("hr.domain"), "left"))
    lo, hi = hours
    flags = {
        "velocity_flag": F.col("e.c1") > c1_over,
        "amount_anomaly_flag": F.col("e.transaction_amt") > amount_factor * F.col("ca.avg_card1_amt"),
        "time_anomaly_flag": F.col("e.hour_of_day").between(lo, hi),
        "email_risk_flag": F.col("hr._risky").isNotNull(),
    }
    flag_cols = {name: F.when(cond, 1).otherwise(0) for name, cond in flags.items()}
    total = None
    for name in FLAG_COLUMNS:
        total = flag_cols[name] if total is None else total + flag_cols[name]
    return scored.select(
        *[F.col(f"e.{c}").alias(c) for c in
          ["transaction_id", "split", "is_fraud", "transaction_amt", "hour_of_day",
           "p_emaildomain", "card1", "c1"]],
        F.col("ca.avg_card1_amt").alias("avg_card1_amt"),
        *[flag_cols[name].alias(name) for name in FLAG_COLUMNS],
        (F.lit(points) * total).alias("risk_score"),
    ).select(*SCORING_COLUMNS)


def scoring_validation(scored: DataFrame) -> DataFrame:
    """Fraud rate per risk score over the train split."""
    fraud = F.sum(fraud_flag()).cast("bigint")
    n = F.count(F.lit(1))
    return (scored.where(F.col("split") == "train")
            .groupBy("risk_score")
            .agg(n.alias("transactions"), fraud.alias("fraud_count"),
                 percent(fraud, n).alias("fraud_rate")))


def rule_lift(scored: DataFrame) -> DataFrame:
    """Per rule: fraud rate on the train split with the flag off and on.

    One pass of conditional counts (8 groups x 2 counts) gives a single row,
    which is then unpivoted into (rule, flag) rows - no row expansion of the
    scored table before aggregating.
    """
    train = scored.where(F.col("split") == "train")
    fraud = F.col("is_fraud")
    aggs = []
    for rule in FLAG_COLUMNS:
        for value in (0, 1):
            hit = F.col(rule) == value
            aggs.append(F.count_if(hit).alias(f"{rule}__{value}__n"))
            aggs.append(F.count_if(hit & fraud).alias(f"{rule}__{value}__f"))
    wide = train.agg(*aggs)
    stack_args = ", ".join(
        f"'{rule}', {value}, `{rule}__{value}__n`, `{rule}__{value}__f`"
        for rule in FLAG_COLUMNS for value in (0, 1))
    long = wide.selectExpr(
        f"stack({len(FLAG_COLUMNS) * 2}, {stack_args}) AS (rule, flag, transactions, fraud_count)")
    # A (rule, flag) pair without rows is no group, as in GROUP BY.
    return (long.where(F.col("transactions") > 0)
            .select("rule", F.col("flag").cast("int").alias("flag"), "transactions",
                    "fraud_count", percent("fraud_count", "transactions").alias("fraud_rate")))
