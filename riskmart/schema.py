"""Names and types of the staged, enriched and derived tables.

The lists below are fixed values: table layouts that must equal the source
pipeline's so that a user's downstream queries keep working.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Column renames applied while staging (other names are only
# lower-cased, with '-' turned into '_').
# ---------------------------------------------------------------------------
RENAME_MAP = {
    "TransactionID": "transaction_id",
    "TransactionDT": "transaction_dt",
    "TransactionAmt": "transaction_amt",
    "ProductCD": "product_cd",
    "isFraud": "is_fraud",
    "DeviceType": "device_type",
    "DeviceInfo": "device_info",
}
# Raw columns lower-cased as text, and raw columns cast to integer.
EMAIL_COLUMNS = ("P_emaildomain", "R_emaildomain")
CARD_INT_COLUMNS = ("card2", "card3", "card5")


def _numbered(prefix: str, first: int, last: int, width: int = 0) -> list[str]:
    return [f"{prefix}{str(i).zfill(width)}" for i in range(first, last + 1)]


C_COLUMNS = _numbered("c", 1, 14)
D_COLUMNS = _numbered("d", 1, 15)
M_COLUMNS = _numbered("m", 1, 9)
V_COLUMNS = _numbered("v", 1, 339)
ID_COLUMNS = _numbered("id_", 1, 38, width=2)

# Staged transaction table: name -> Spark SQL type, in table order.
TRANSACTION_TYPES: dict[str, str] = {
    "split": "string",
    "transaction_id": "bigint",
    "is_fraud": "boolean",
    "transaction_dt": "bigint",
    "transaction_amt": "double",
    "product_cd": "string",
    "card1": "bigint",
    "card2": "int",
    "card3": "int",
    "card4": "string",
    "card5": "int",
    "card6": "string",
    "addr1": "double",
    "addr2": "double",
    "dist1": "double",
    "dist2": "double",
    "p_emaildomain": "string",
    "r_emaildomain": "string",
    **{c: "double" for c in C_COLUMNS},
    **{c: "double" for c in D_COLUMNS},
    **{c: "string" for c in M_COLUMNS},
    **{c: "double" for c in V_COLUMNS},
}

# Identity attributes id_01..id_11 are numeric, id_12..id_38 text except the
# two numeric ones below (fixed values).
NUMERIC_TEXT_RANGE_IDS = ("id_13", "id_14")
IDENTITY_TYPES: dict[str, str] = {
    "split": "string",
    "transaction_id": "bigint",
    **{c: ("double" if int(c[3:]) <= 11 or c in NUMERIC_TEXT_RANGE_IDS else "string")
       for c in ID_COLUMNS},
    "device_type": "string",
    "device_info": "string",
}

# ---------------------------------------------------------------------------
# The enriched table keeps these staged columns, in this order.
# ---------------------------------------------------------------------------
ENRICHED_TRANSACTION_COLUMNS = [
    "split", "transaction_id", "is_fraud", "transaction_dt", "transaction_amt",
    "product_cd", "card1", "card2", "card3", "card4", "card5", "card6",
    "addr1", "addr2", "dist1", "dist2", "p_emaildomain", "r_emaildomain",
    *C_COLUMNS,
]
ENRICHED_IDENTITY_COLUMNS = [
    "id_12", "id_13", "id_14", "id_15", "id_16", "id_17", "id_18", "id_19", "id_20",
    "id_30", "id_31", "id_35", "id_36", "id_37", "id_38", "device_type", "device_info",
]
DERIVED_COLUMNS = ["hour_of_day", "day_of_week", "amount_bucket"]
ENRICHED_COLUMNS = ENRICHED_TRANSACTION_COLUMNS + ENRICHED_IDENTITY_COLUMNS + DERIVED_COLUMNS

# The fraud fact mart (train split only).
FACT_COLUMNS = [
    "transaction_id", "is_fraud", "transaction_amt", "amount_bucket", "hour_of_day",
    "day_of_week", "product_cd", "card4", "card6", "p_emaildomain", "device_type",
    "device_info", "id_12", "id_13", "id_14", "id_15",
]

# The scoring table.
SCORING_COLUMNS = [
    "transaction_id", "split", "is_fraud", "transaction_amt", "hour_of_day",
    "p_emaildomain", "card1", "c1", "avg_card1_amt", "velocity_flag",
    "amount_anomaly_flag", "time_anomaly_flag", "email_risk_flag", "risk_score",
]
FLAG_COLUMNS = ["velocity_flag", "amount_anomaly_flag", "time_anomaly_flag", "email_risk_flag"]

# The case-note table (key, six answer fields, raw text, time).
CASE_NOTE_TYPES: dict[str, str] = {
    "transaction_id": "string",
    "risk_assessment": "string",
    "likely_pattern": "string",
    "confidence": "double",
    "reasoning": "string",
    "recommended_action": "string",
    "case_note": "string",
    "raw_response": "string",
    "created_at": "timestamp",
}
ANSWER_FIELDS = ["risk_assessment", "likely_pattern", "confidence", "reasoning",
                 "recommended_action", "case_note"]
RISK_LEVELS = ["low", "medium", "high", "critical"]

# Null-rate report columns.
TRANSACTION_NULL_REPORT = ["dist1", "dist2", "p_emaildomain", "r_emaildomain", "addr1", "addr2",
                           "d2", "d6", "d7", "d8", "d9", "m1", "m5"]
IDENTITY_NULL_REPORT = ["id_01", "id_02", "id_07", "id_08", "id_12", "id_15", "id_30", "id_31",
                        "device_type", "device_info"]


def ddl(types: dict[str, str]) -> str:
    """``name type, ...`` schema string for ``spark.read.schema`` / ``createDataFrame``."""
    return ", ".join(f"`{name}` {typ}" for name, typ in types.items())
