"""Column expressions built from ``pyspark.sql.functions`` only (no UDFs)."""

from riskmart.functions.derived import (  # noqa: F401
    amount_bucket, day_of_week, fraud_flag, hour_of_day, percent, round_half_away, score_band,
)
