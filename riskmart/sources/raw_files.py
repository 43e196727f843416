"""Adapter: the driver's ``events`` table as the four raw CSV files a load starts from.

Raw header names (with ``-`` in the test identity file), mixed-case e-mail domains,
card numbers as ``404.0`` or unreadable text, empty fields, amounts over 500 and
missing ones, and columns that no layout lists.  The rules are fixed by the
checks, as those of ``sources/events.py``.  ``write_faulty`` writes the same rows with some
records that no load can take.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RAW_WRITE = {"header": "true", "escape": '"', "emptyValue": "", "lineSep": "\n"}

_TRANSACTION = {
    "TransactionID": "transaction_id",
    "isFraud": "CAST(is_fraud AS INT)",
    "TransactionDT": "transaction_dt",
    "TransactionAmt": "CASE WHEN transaction_id % 97 = 0 THEN NULL "
                      "WHEN transaction_id % 89 = 0 THEN transaction_amt + 1000 ELSE transaction_amt END",
    "ProductCD": "product_cd",
    "card1": "card1",
    "card2": "CASE transaction_id % 5 WHEN 0 THEN '404.0' WHEN 1 THEN 'abc' WHEN 2 THEN NULL "
             "ELSE CAST(transaction_id % 600 AS STRING) END",
    "card3": "'150.0'",
    "card4": "card4",
    "card5": "CASE WHEN transaction_id % 3 > 0 THEN '226' END",
    "card6": "card6",
    "addr1": "CAST(transaction_id % 400 AS DOUBLE)",
    "addr2": "CASE WHEN transaction_id % 7 > 0 THEN 87.0D END",
    "dist1": "CASE WHEN transaction_id % 3 = 0 THEN transaction_id % 50 + 0.5D END",
    "P_emaildomain": "CASE WHEN transaction_id % 2 = 0 THEN upper(p_emaildomain) ELSE initcap(p_emaildomain) END",
    "R_emaildomain": "r_emaildomain",
    "C1": "c1",
    "D2": "CASE WHEN transaction_id % 4 > 0 THEN transaction_id % 30 END",
    "M1": "CASE transaction_id % 3 WHEN 0 THEN 'T' WHEN 1 THEN 'F' END",
    "M5": "CASE WHEN transaction_id % 6 = 0 THEN 'T' END",
    "V1": "transaction_id % 2",
    "Extra-Col": "concat('note ', transaction_id, ', \"as is\"')",
    "Extra-Count": "CASE WHEN transaction_id % 11 > 0 THEN transaction_id * 1000000007 END",
    "Extra-Ratio": "CASE WHEN transaction_id % 2 = 0 THEN '7' ELSE concat(transaction_id % 10, '.25') END",
    "Extra-Day": "date_add(DATE'2024-01-01', CAST(transaction_id % 365 AS INT))",
    "Extra-Seen": "concat('2024-02-03 04:05:', lpad(transaction_id % 60, 2, '0'))",
    "Extra-Flag": "CASE WHEN transaction_id % 3 > 0 THEN transaction_id % 3 = 1 END",
    "Extra-Mixed": "CASE WHEN transaction_id % 2 = 0 THEN '12' ELSE 'true' END",
    "Extra-None": "CAST(NULL AS STRING)",
}
_IDENTITY = {
    "TransactionID": "transaction_id",
    "id-01": "CAST(-(transaction_id % 100) AS DOUBLE)",
    "id-02": "CASE WHEN transaction_id % 5 > 0 THEN transaction_id * 10 END",
    "id-12": "CASE WHEN transaction_id % 8 = 0 THEN 'Found' ELSE 'NotFound' END",
    "id-31": "CASE WHEN transaction_id % 16 = 0 THEN 'chrome 62.0, \"mobile\"' END",
    "DeviceType": "device_type",
    "DeviceInfo": "device_info",
}


def _raw(staged: DataFrame, split: str, columns: dict[str, str]) -> DataFrame:
    return staged.where(F.col("split") == split).select(*(F.expr(e).alias(c) for c, e in columns.items()))


def raw_files(transactions: DataFrame, identity: DataFrame) -> dict[str, DataFrame]:
    """Staged rows of the events as the four raw inputs, by the keys of ``RAW_FILES``."""
    return {
        "train_transaction": _raw(transactions, "train", _TRANSACTION),
        "test_transaction": _raw(transactions, "test", {c: e for c, e in _TRANSACTION.items() if c != "isFraud"}),
        "train_identity": _raw(identity, "train", {c.replace("id-", "id_"): e for c, e in _IDENTITY.items()}),
        "test_identity": _raw(identity, "test", _IDENTITY),
    }


def write_faulty(df: DataFrame, path: str) -> None:
    """Write as raw CSV, with fields too many, records cut short and keys that are no whole number."""
    key, names = F.col("TransactionID"), [f"`{c}`" for c in df.columns]
    text = F.when(key % 521 == 0, F.concat(key, F.lit(".5"))).otherwise(key.cast("string")).alias("TransactionID")
    fields = [text, *names[1:]]                 # the key is every file's first column
    options = {k: RAW_WRITE[k] for k in ("escape", "emptyValue")}
    line, short = F.to_csv(F.struct(*fields), options), F.to_csv(F.struct(*fields[:3]), options)
    rows = df.select(F.when(key % 503 == 0, F.concat(line, F.lit(",EXTRA,FIELDS"))).when(key % 509 == 0, short)
                     .otherwise(line).alias(",".join(df.columns)))
    # lines as they are: no quoting, and a separator that is in no text
    rows.write.mode("overwrite").options(header="true", sep="\u0001", quote="", lineSep="\n").csv(path)


def write_raw(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**RAW_WRITE).csv(path)
