"""Dashboard data: the reporting join, its measures and the eleven worksheets.

The base is ``fact LEFT JOIN notes LEFT JOIN scoring`` on ``transaction_id``.
Columns that exist on both sides keep the fact's name; the scoring and note
copies get a ``scoring_`` / ``note_`` prefix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.derived import score_band
from riskmart.functions.exact import exact_sum
from riskmart.operators.joins import broadcast_if_small
from riskmart.schema import FACT_COLUMNS, SCORING_COLUMNS

NOTE_FIELDS = ["risk_assessment", "likely_pattern", "confidence", "reasoning",
               "recommended_action", "case_note", "raw_response", "created_at"]


def report_base(fact: DataFrame, notes: DataFrame, scored: DataFrame,
                note_broadcast_rows: int = 20_000) -> DataFrame:
    """The dashboard's join tree as one frame.

    Notes are few (one per reviewed transaction) but wide (answer texts): broadcast
    only after a count of their rows and bytes, else a shuffle join.  Fact and scoring are both large and
    joined on their unique key.
    """
    f = fact.alias("f")
    n = broadcast_if_small(
        notes.select(F.col("transaction_id").try_cast("bigint").alias("note_transaction_id"),
                     *NOTE_FIELDS), note_broadcast_rows).alias("n")
    s_cols = [F.col(c).alias(f"scoring_{c}" if c in FACT_COLUMNS else c) for c in SCORING_COLUMNS]
    s = scored.select(*s_cols).alias("s")
    return (f.join(n, F.col("f.transaction_id") == F.col("n.note_transaction_id"), "left")
            .join(s, F.col("f.transaction_id") == F.col("s.scoring_transaction_id"), "left"))


def _fraud_count():
    return F.sum(F.when(F.col("is_fraud") == F.lit(True), 1).otherwise(0)).cast("bigint")


def fraud_rate_measure():
    """Fraction of fraud rows per counted transaction id."""
    return F.try_divide(_fraud_count(), F.count("transaction_id"))


def kpis(base: DataFrame) -> DataFrame:
    """fraud_count, fraud_rate, amount_at_risk, total_transactions in one pass."""
    return base.agg(
        _fraud_count().alias("fraud_count"),
        fraud_rate_measure().alias("fraud_rate"),
        exact_sum(F.when(F.col("is_fraud") == F.lit(True), F.col("transaction_amt"))
                  .otherwise(F.lit(0.0))).alias("amount_at_risk"),
        F.count("transaction_id").alias("total_transactions"),
    )


def fraud_rate_by(base: DataFrame, dimension, name: str, descending: bool = True) -> DataFrame:
    """Fraud rate per value of ``dimension`` (NULL is a group), optionally highest first."""
    dim = F.col(dimension) if isinstance(dimension, str) else dimension
    out = base.groupBy(dim.alias(name)).agg(fraud_rate_measure().alias("fraud_rate"))
    if descending:
        out = out.orderBy(F.desc_nulls_last("fraud_rate"), F.asc_nulls_first(name))
    return out


def fraud_rate_by_hour(base):
    return fraud_rate_by(base, "scoring_hour_of_day", "hour_of_day", descending=False) \
        .orderBy(F.asc_nulls_first("hour_of_day"))


def fraud_rate_by_card_network(base):
    return fraud_rate_by(base, "card4", "card4")


def fraud_rate_by_product(base):
    return fraud_rate_by(base, "product_cd", "product_cd")


def fraud_rate_by_score_band(base):
    return fraud_rate_by(base, score_band("risk_score"), "score_band")


def scoring_performance(base):
    return fraud_rate_by(base, score_band("risk_score"), "score_band", descending=False)


QUEUE_COLUMNS = ["risk_score", "transaction_amt", "time_anomaly_flag", "amount_anomaly_flag",
                 "email_risk_flag", "velocity_flag", "card4"]
DEEP_DIVE_COLUMNS = ["transaction_id", "transaction_amt", "product_cd", "card4", "risk_score",
                     "risk_assessment", "likely_pattern", "recommended_action", "confidence",
                     "case_note"]


def investigation_queue(base: DataFrame, min_score: int = 50, members=None) -> DataFrame:
    """Distinct rows of the seven queue columns with ``risk_score >= min_score``
    (optionally only the listed scores), highest score first."""
    cond = F.col("risk_score") >= min_score
    if members is not None:
        cond = cond & F.col("risk_score").isin(list(members))
    return (base.where(cond).select(*QUEUE_COLUMNS).distinct()
            .orderBy(F.desc_nulls_last("risk_score"), F.desc_nulls_last("transaction_amt")))


def deep_dive(base: DataFrame, transaction_ids) -> DataFrame:
    """Distinct rows of the ten deep-dive columns for the chosen transaction(s).

    ``transaction_ids`` is an id, a list of ids, or a one-column frame of ids
    (joined as a semi join, broadcast behind a row check).
    """
    if isinstance(transaction_ids, DataFrame):
        ids = broadcast_if_small(transaction_ids.select(F.col("transaction_id").alias("__id")))
        picked = base.join(ids, F.col("transaction_id") == F.col("__id"), "left_semi")
    else:
        if not isinstance(transaction_ids, (list, tuple, set)):
            transaction_ids = [transaction_ids]
        picked = base.where(F.col("transaction_id").isin(list(transaction_ids)))
    return picked.select(*DEEP_DIVE_COLUMNS).distinct()


# Worksheet dimensions for the one-pass refresh, in grouping order.
_SHEET_DIMENSIONS = [("fraud_rate_by_hour", "hour_of_day"),
                     ("fraud_rate_by_card_network", "card4"),
                     ("fraud_rate_by_product", "product_cd"),
                     ("fraud_rate_by_score_band", "score_band")]


def worksheet_measures(base: DataFrame) -> DataFrame:
    """Every worksheet's measures from one pass over the extract (grouping sets).

    Rows: (worksheet, value, fraud_count, fraud_rate, amount_at_risk,
    total_transactions); ``value`` is the dimension value as text, and the row
    with worksheet ``kpi_overview`` is the grand total.  One scan and one
    partial-aggregate shuffle replace one job per worksheet.  On an empty
    extract grouping sets yield no rows; :func:`kpis` still gives its one row.
    """
    dims = [d for _, d in _SHEET_DIMENSIONS]
    df = base.select(F.col("scoring_hour_of_day").cast("string").alias("hour_of_day"),
                     "card4", "product_cd", score_band("risk_score").alias("score_band"),
                     "is_fraud", "transaction_id", "transaction_amt")
    sets = [[d] for d in dims] + [[]]
    agg = df.groupingSets(sets, *dims).agg(
        F.grouping_id().alias("__gid"),
        _fraud_count().alias("fraud_count"),
        fraud_rate_measure().alias("fraud_rate"),
        F.sum(F.when(F.col("is_fraud") == F.lit(True), F.col("transaction_amt"))
              .otherwise(F.lit(0.0))).alias("amount_at_risk"),
        F.count("transaction_id").alias("total_transactions"))
    full = (1 << len(dims)) - 1
    sheet = F.when(F.col("__gid") == full, F.lit("kpi_overview"))
    value = F.lit(None).cast("string")
    for i, (name, dim) in enumerate(_SHEET_DIMENSIONS):
        gid = full ^ (1 << (len(dims) - 1 - i))        # only this dimension grouped
        sheet = sheet.when(F.col("__gid") == gid, F.lit(name))
        value = F.when(F.col("__gid") == gid, F.col(dim)).otherwise(value)
    return agg.select(sheet.alias("worksheet"), value.alias("value"), "fraud_count",
                      "fraud_rate", "amount_at_risk", "total_transactions")
