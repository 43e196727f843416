"""Written layers: each pipeline layer is a Parquet table in a shared folder.

Writing a layer cuts the lineage (later jobs read files, not the plan that made
them) and lets every downstream query scan only the columns and splits it needs:
tables carrying ``split`` are partitioned by it, so ``split = 'train'`` prunes
whole directories.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from riskmart.session import join_path, open_writers


class LayerStore:
    """Parquet tables under one root folder, addressed by layer name."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._orders: dict[str, list[str]] = {}
        # Frames over written tables, kept so repeated reads do not list files again.
        # This holds query plans only, never data; a rewrite replaces the entry.
        self._frames: dict[str, DataFrame] = {}
        self._schemas: dict[str, StructType] = {}

    def path(self, name: str) -> str:
        return join_path(self.root, name)

    def write(self, name: str, df: DataFrame, partition_by: str | None = None,
              mode: str = "overwrite") -> DataFrame:
        """Write ``df`` as layer ``name`` and return the written table."""
        # zstd: smaller files than the default codec, so every later scan reads less.
        writer = df.write.mode(mode).option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        with open_writers(self.spark):
            writer.parquet(self.path(name))
        self._orders[name] = list(df.columns)
        self._schemas[name] = df.schema
        self._frames.pop(name, None)
        try:
            self._frames[name] = self.spark.read.parquet(self.path(name))
        except AnalysisException:
            # An empty partitioned write leaves no data file to take the schema
            # from; keep it in a small side file so other sessions can read it.
            self._write_schema_file(name, df.schema)
        return self.read(name)

    def read(self, name: str, order: list[str] | None = None) -> DataFrame:
        df = self._frames.get(name)
        if df is None:
            try:
                df = self.spark.read.parquet(self.path(name))
            except AnalysisException:
                schema = self._schemas.get(name) or self._read_schema_file(name)
                if schema is None:
                    raise
                df = self.spark.read.schema(schema).parquet(self.path(name))
            self._frames[name] = df
        order = order or self._orders.get(name)
        if order and set(order) == set(df.columns):
            df = df.select(*[f"`{c}`" for c in order])
        return df

    def _schema_path(self, name: str) -> str:
        return join_path(self.root, f"_schema_{name}")

    def _write_schema_file(self, name: str, schema: StructType) -> None:
        (self.spark.createDataFrame([(schema.json(),)], "s string").coalesce(1)
         .write.mode("overwrite").text(self._schema_path(name)))

    def _read_schema_file(self, name: str) -> StructType | None:
        try:
            row = self.spark.read.text(self._schema_path(name)).first()
        except AnalysisException:
            return None
        return StructType.fromJson(json.loads(row[0])) if row else None

    def exists(self, name: str) -> bool:
        """True when layer ``name`` was written completely (its commit marker exists)."""
        if name in self._frames:
            return True
        try:
            self.spark.read.text(join_path(self.path(name), "_SUCCESS")).schema
            return True
        except AnalysisException:
            return False


# Layers keyed by transaction that are joined with each other on that key.
BUCKETED_LAYERS = ("stg_transactions", "stg_identity", "int_transactions_enriched",
                   "fct_fraud_analysis", "rule_based_scoring")
BUCKET_KEY = "transaction_id"


class CatalogLayerStore(LayerStore):
    """Layers as catalog tables; the transaction-keyed ones bucketed by ``transaction_id``.

    With the same bucket count on both sides, the big joins on the key
    (transactions with identity, fact with scoring) read co-located buckets and
    need no shuffle of either side.  Needs a catalog that keeps bucket specs
    (a metastore on a cluster; the in-memory catalog within one session).
    ``location`` is the database folder on shared storage.
    """

    def __init__(self, spark: SparkSession, database: str, location: str, buckets: int = 64):
        super().__init__(spark, location)
        self.database = database
        self.buckets = buckets
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")

    def table_name(self, name: str) -> str:
        return f"`{self.database}`.`{name}`"

    def write(self, name: str, df: DataFrame, partition_by: str | None = None,
              mode: str = "overwrite") -> DataFrame:
        writer = df.write.mode(mode).format("parquet").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        if name in BUCKETED_LAYERS and BUCKET_KEY in df.columns:
            writer = writer.bucketBy(self.buckets, BUCKET_KEY).sortBy(BUCKET_KEY)
        writer.saveAsTable(f"{self.database}.{name}")
        self._orders[name] = list(df.columns)
        self._frames.pop(name, None)
        return self.read(name)

    def read(self, name: str, order: list[str] | None = None) -> DataFrame:
        df = self._frames.get(name)
        if df is None:
            self.spark.catalog.refreshTable(f"{self.database}.{name}")
            df = self._frames[name] = self.spark.table(self.table_name(name))
        order = order or self._orders.get(name)
        if order and set(order) == set(df.columns):
            df = df.select(*[f"`{c}`" for c in order])
        return df

    def exists(self, name: str) -> bool:
        return name in self._frames or self.spark.catalog.tableExists(f"{self.database}.{name}")
