"""Quality report on the staged tables, each figure a small DataFrame."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.derived import percent, round_half_away
from riskmart.schema import CARD_INT_COLUMNS


def split_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per split for each named table."""
    out = None
    for name, df in tables.items():
        part = (df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
                .select(F.lit(name).alias("table_name"), "split", "rows"))
        out = part if out is None else out.unionByName(part)
    return out.orderBy("table_name", "split")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, position, null_count, total_rows, null_pct) for ``columns`` in one scan.

    One global aggregate counts every column's NULLs at once (partial per task,
    so the scan is a single pass); the one-row result is then unpivoted.
    """
    aggs = [F.count(F.lit(1)).alias("__total")]
    aggs += [(F.count(F.lit(1)) - F.count(F.col(c))).alias(f"__n{i}") for i, c in enumerate(columns)]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', {i + 1}, `__n{i}`" for i, c in enumerate(columns))
    long = wide.selectExpr("__total",
                           f"stack({len(columns)}, {pairs}) AS (column_name, position, null_count)")
    return long.select("column_name", F.col("position").cast("int").alias("position"),
                       "null_count", F.col("__total").alias("total_rows"),
                       percent("null_count", "__total").alias("null_pct"))


def identity_coverage(transactions: DataFrame, identity: DataFrame) -> DataFrame:
    """Per split of the transactions: rows, rows with an identity row, percent (1 decimal)."""
    t = transactions.select("split", "transaction_id").alias("t")
    i = identity.select("transaction_id").alias("i")
    joined = t.join(i, F.col("t.transaction_id") == F.col("i.transaction_id"), "left")
    total = F.count(F.lit(1))
    matched = F.count(F.col("i.transaction_id"))
    return (joined.groupBy(F.col("t.split").alias("split"))
            .agg(total.alias("total_txns"), matched.alias("with_identity"),
                 round_half_away(percent(matched, total), 1).alias("pct"))
            .orderBy("split"))


def train_fraud_rate(transactions: DataFrame) -> DataFrame:
    """Train rows, fraud rows and fraud percent."""
    fraud = F.sum(F.col("is_fraud").cast("int")).cast("bigint")
    total = F.count(F.lit(1))
    return (transactions.where(F.col("split") == "train")
            .agg(total.alias("total_transactions"), fraud.alias("fraud_count"),
                 percent(fraud, total).alias("fraud_rate")))


# Spark type names as standard SQL type names (the source reports its catalog's names).
SQL_TYPE_NAMES = {"tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER",
                  "bigint": "BIGINT", "float": "FLOAT", "double": "DOUBLE", "string": "VARCHAR",
                  "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def type_check(transactions: DataFrame, columns=CARD_INT_COLUMNS) -> DataFrame:
    """(column_name, data_type, status): OK when the staged column has an integer type.

    Read from the table's catalog description (``DESCRIBE``), like a query on
    the information schema: no data is scanned.
    """
    spark = transactions.sparkSession
    view = f"_riskmart_describe_{uuid.uuid4().hex}"
    transactions.createOrReplaceTempView(view)
    try:
        described = spark.sql(f"DESCRIBE {view}")          # runs now; result is local
    finally:
        spark.catalog.dropTempView(view)
    names = F.create_map(*[F.lit(x) for kv in SQL_TYPE_NAMES.items() for x in kv])
    sql_type = F.coalesce(F.element_at(names, F.col("data_type")), F.upper("data_type"))
    return (described.where(F.col("col_name").isin(list(columns)))
            .select(F.col("col_name").alias("column_name"), sql_type.alias("data_type"))
            .select("column_name", "data_type",
                    F.when(F.col("data_type").contains("INT"), "OK")
                    .otherwise("WARN - expected INTEGER").alias("status"))
            .orderBy("column_name"))
