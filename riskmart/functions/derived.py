"""Derived features and numeric helpers, all JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_HOUR = 3600
SECONDS_PER_DAY = 86400
SECONDS_PER_WEEK = 604800

# Amount bands (upper bounds, exclusive) and their labels.
AMOUNT_BANDS = [(10, "under_10"), (50, "10_to_50"), (200, "50_to_200"), (500, "200_to_500")]
AMOUNT_TOP_BAND = "over_500"

# Dashboard score bands, highest first.
SCORE_BANDS = [(75, "Critical (75)"), (50, "High (50)"), (25, "Medium (25)")]
SCORE_BOTTOM_BAND = "Low (0)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _nearest_int(x: Column) -> Column:
    # Casting a fractional double to an integer in the source pipeline rounds to
    # the nearest integer, ties to even (1800 s -> hour 0, 5400 s -> hour 2).
    return F.rint(x).cast("int")


def hour_of_day(dt="transaction_dt", mode: str = "round") -> Column:
    """Hour within the day of a seconds offset.

    ``mode="round"`` reproduces the source SQL (values 0..24); ``"floor"`` gives
    the documented 0..23 clock hour.
    """
    frac = (_col(dt) % SECONDS_PER_DAY) / SECONDS_PER_HOUR
    return _nearest_int(frac) if mode == "round" else F.floor(frac).cast("int")


def day_of_week(dt="transaction_dt", mode: str = "round") -> Column:
    """Day within the week of a seconds offset (0..7 as in the source SQL, or 0..6 floored)."""
    frac = (_col(dt) % SECONDS_PER_WEEK) / SECONDS_PER_DAY
    return _nearest_int(frac) if mode == "round" else F.floor(frac).cast("int")


def amount_bucket(amount="transaction_amt") -> Column:
    """Amount band; anything not below 500 - NULL included - is the top band."""
    amt = _col(amount)
    expr = None
    for bound, label in AMOUNT_BANDS:
        expr = F.when(amt < bound, label) if expr is None else expr.when(amt < bound, label)
    return expr.otherwise(AMOUNT_TOP_BAND)


def round_half_away(x, digits: int) -> Column:
    """``round(x * 10^d) / 10^d`` with ties away from zero.

    This is how the source database rounds doubles (``ROUND(1.005, 2)`` is 1.0,
    ``ROUND(2.675, 2)`` is 2.68).  Spark's ``round`` on the scaled value is exact
    for that step because the scaled double is rounded as written.
    """
    scale = float(10 ** digits)
    return F.round(_col(x) * F.lit(scale), 0) / F.lit(scale)


def percent(part, whole) -> Column:
    """``100 * part / whole`` as a double; NULL when ``whole`` is 0."""
    return F.try_divide(F.lit(100.0) * _col(part), _col(whole))


def fraud_flag(is_fraud="is_fraud") -> Column:
    """1 when the label is true, else 0 (NULL label counts 0)."""
    return F.when(_col(is_fraud), F.lit(1)).otherwise(F.lit(0))


def score_band(score="risk_score") -> Column:
    """Dashboard band of a 0-100 score; NULL falls to the bottom band."""
    s = _col(score)
    expr = None
    for bound, label in SCORE_BANDS:
        expr = F.when(s >= bound, label) if expr is None else expr.when(s >= bound, label)
    return expr.otherwise(SCORE_BOTTOM_BAND)
