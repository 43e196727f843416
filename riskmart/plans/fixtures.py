"""Answer fixture: review answers derived from the candidate rows.

The review service is outside this library; its answers are an input table.
For the checks, answers are made from the candidates themselves (so they grow
with the data), three attempts each, the shape of attempt ``a`` of transaction
``t`` picked by ``(t + a + shift) % 8``:

0 the object; 1 the object in a ```json fence; 2 prose around the object;
3 the object plus `` also }``; 4 truncated (last brace cut); 5 no JSON;
6 risk ``severe``; 7 confidence 1.5.  Shapes 0-2 are valid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ATTEMPTS = 3


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def _body(risk: Column, confidence_text: Column) -> Column:
    return F.concat(
        F.lit('{"risk_assessment": '), _quoted(risk),
        F.lit(', "likely_pattern": '), _quoted(F.col("__pattern")),
        F.lit(', "confidence": '), confidence_text,
        F.lit(', "reasoning": '), _quoted(F.col("__reasoning")),
        F.lit(', "recommended_action": '), _quoted(F.col("__action")),
        F.lit(', "case_note": '), _quoted(F.col("__note")), F.lit("}"))


def answers_for(candidate_rows: DataFrame, shift: int = 0) -> DataFrame:
    """(transaction_id, attempt, raw_response) for every candidate and attempt."""
    score, fraud, tid = F.col("risk_score"), F.col("is_fraud"), F.col("transaction_id")
    parts = candidate_rows.select(
        "transaction_id",
        F.explode(F.sequence(F.lit(1), F.lit(ATTEMPTS))).alias("attempt"),
        (F.when(score >= 100, "critical").when(fraud, "high").when(score >= 75, "medium")
         .otherwise("low")).alias("__risk"),
        (F.when(F.col("email_risk_flag") == 1, "account_takeover")
         .when(F.col("velocity_flag") == 1, "card_testing")
         .otherwise("insufficient_evidence")).alias("__pattern"),
        F.concat(F.lit("0."), ((tid % 9) + 1).cast("string")).alias("__conf"),
        F.concat(F.lit("Score "), score.cast("string"), F.lit(" on card "),
                 F.coalesce(F.col("card1").cast("string"), F.lit("none")), F.lit(".")
                 ).alias("__reasoning"),
        (F.when(score >= 100, "decline").when(fraud, "escalate_to_senior")
         .when(score >= 75, "hold_for_review").otherwise("approve")).alias("__action"),
        F.concat(F.lit("Transaction "), tid.cast("string"), F.lit(" reviewed {auto}.")
                 ).alias("__note"),
    )
    shape = (F.col("transaction_id") + F.col("attempt") + F.lit(shift)) % 8
    bodies = parts.select(
        "transaction_id", "attempt", shape.alias("__shape"),
        _body(F.col("__risk"), F.col("__conf")).alias("__good"),
        _body(F.lit("severe"), F.col("__conf")).alias("__severe"),
        _body(F.col("__risk"), F.lit("1.5")).alias("__overconfident"))
    good = F.col("__good")
    raw = (F.when(F.col("__shape") == 0, good)
           .when(F.col("__shape") == 1, F.concat(F.lit("```json\n"), good, F.lit("\n```")))
           .when(F.col("__shape") == 2, F.concat(F.lit("Here is my assessment. "), good,
                                                 F.lit(" Let me know if more is needed.")))
           .when(F.col("__shape") == 3, F.concat(good, F.lit(" also }")))
           .when(F.col("__shape") == 4, F.expr("substring(__good, 1, length(__good) - 1)"))
           .when(F.col("__shape") == 5, F.lit("I could not assess this transaction."))
           .when(F.col("__shape") == 6, F.col("__severe"))
           .otherwise(F.col("__overconfident")))
    return bodies.select("transaction_id", "attempt", raw.alias("raw_response"))
