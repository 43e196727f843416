"""Ordered layer build: staging -> enriched -> marts -> scoring.

Every layer is written to the layer store before the next one reads it, as the
source pipeline materializes each table.  Without this the scoring plan would
scan the raw inputs six times (base rows, card average, domain rates, each for
both inputs).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.operators.enrich import enrich
from riskmart.operators.marts import email_domain_mart, fraud_fact
from riskmart.operators.scoring import card_average, score
from riskmart.operators.staging import stage_identity, stage_transactions
from riskmart.schema import (
    CASE_NOTE_TYPES, ENRICHED_COLUMNS, FACT_COLUMNS, IDENTITY_TYPES, SCORING_COLUMNS,
    TRANSACTION_TYPES, ddl,
)
from riskmart.session import join_path
from riskmart.sources.csv import export_csv, import_csv, read_raw_csv
from riskmart.sources.tables import LayerStore

# Layer names in build order, with the column a layer is partitioned by.
LAYERS = [
    ("stg_transactions", "split"),
    ("stg_identity", "split"),
    ("int_transactions_enriched", "split"),
    ("fct_fraud_analysis", None),
    ("agg_fraud_by_email_domain", None),
    ("rule_based_scoring", "split"),
]
_ORDERS = {
    "stg_transactions": list(TRANSACTION_TYPES),
    "stg_identity": list(IDENTITY_TYPES),
    "int_transactions_enriched": ENRICHED_COLUMNS,
    "rule_based_scoring": SCORING_COLUMNS,
}


@dataclass
class Layers:
    """The written tables of one pipeline run."""

    store: LayerStore

    def table(self, name: str) -> DataFrame:
        return self.store.read(name, _ORDERS.get(name))

    @property
    def stg_transactions(self) -> DataFrame:
        return self.table("stg_transactions")

    @property
    def stg_identity(self) -> DataFrame:
        return self.table("stg_identity")

    @property
    def enriched(self) -> DataFrame:
        return self.table("int_transactions_enriched")

    @property
    def fact(self) -> DataFrame:
        return self.table("fct_fraud_analysis")

    @property
    def domain_mart(self) -> DataFrame:
        return self.table("agg_fraud_by_email_domain")

    @property
    def scoring(self) -> DataFrame:
        return self.table("rule_based_scoring")

    def complete(self) -> bool:
        return all(self.store.exists(name) for name, _ in LAYERS)


def build_layers(store: LayerStore, stg_transactions: DataFrame, stg_identity=None, *,
                 identity_from_transactions=None, staged: bool = False, hour_mode: str = "round",
                 min_rows: int = 100, **score_args) -> Layers:
    """Write all layers in dependency order and return them.

    ``stg_identity`` is a frame, or ``identity_from_transactions`` a function
    that derives it from the written transaction table (the events adapter).
    ``staged``: both staged tables are written already.
    """
    partition = dict(LAYERS)
    txn = stg_transactions if staged else store.write("stg_transactions", stg_transactions, partition["stg_transactions"])
    ident = stg_identity if stg_identity is not None else identity_from_transactions(txn)
    if not staged:
        ident = store.write("stg_identity", ident, partition["stg_identity"])
    enriched = store.write("int_transactions_enriched", enrich(txn, ident, hour_mode),
                           partition["int_transactions_enriched"])
    fact = store.write("fct_fraud_analysis", fraud_fact(enriched))
    mart = store.write("agg_fraud_by_email_domain", email_domain_mart(fact, min_rows))
    averages = store.write("card_average", card_average(enriched))
    store.write("rule_based_scoring", score(enriched, mart, averages=averages, **score_args),
                partition["rule_based_scoring"])
    return Layers(store)


def layer_row_counts(layers: Layers) -> DataFrame:
    """(step, rows) for every written layer, in build order."""
    frames = [layers.table(name).agg(F.count(F.lit(1)).alias("rows"))
              .select(F.lit(i + 1).alias("step"), F.lit(name).alias("table_name"), "rows")
              for i, (name, _) in enumerate(LAYERS)]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def open_layers(spark: SparkSession, root: str) -> Layers:
    return Layers(LayerStore(spark, root))


# ---------------------------------------------------------------------------
# Raw CSV input and dashboard CSV output
# ---------------------------------------------------------------------------

# Raw file names of the four inputs.
RAW_FILES = {
    "train_transaction": "train_transaction.csv",
    "test_transaction": "test_transaction.csv",
    "train_identity": "train_identity.csv",
    "test_identity": "test_identity.csv",
}


def staged_from_csv(spark: SparkSession, raw_dir: str) -> tuple[DataFrame, DataFrame]:
    """Staged transaction and identity tables from the four raw CSV files."""
    def raw(key):
        return read_raw_csv(spark, join_path(raw_dir, RAW_FILES[key]))
    txn = stage_transactions(raw("train_transaction"), raw("test_transaction"))
    ident = stage_identity(raw("train_identity"), raw("test_identity"))
    return txn, ident


def export_dashboard(layers: Layers, notes: DataFrame, out_dir: str) -> dict[str, str]:
    """Write the mart, the scoring table and the case notes as CSV for the dashboard."""
    paths = {}
    for name, df in (("fct_fraud_analysis", layers.fact.select(*FACT_COLUMNS)),
                     ("rule_based_scoring", layers.scoring),
                     ("case_notes", notes)):
        paths[name] = join_path(out_dir, name)
        export_csv(df, paths[name])
    return paths


def dashboard_schemas(layers: Layers) -> dict:
    """Declared schemas of the exported files (the written layers' own types)."""
    return {
        "fct_fraud_analysis": layers.fact.select(*FACT_COLUMNS).schema,
        "rule_based_scoring": layers.scoring.schema,
        "case_notes": ddl(CASE_NOTE_TYPES),
    }


def read_dashboard(spark: SparkSession, paths: dict[str, str], schemas: dict
                   ) -> dict[str, DataFrame]:
    """The dashboard's three text sources with their declared types."""
    return {name: import_csv(spark, path, schemas[name]) for name, path in paths.items()}
