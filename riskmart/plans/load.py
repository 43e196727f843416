"""The load of the raw CSV files: typed tables, and an account of every record.

Each raw record ends up in its staged table or in ``load_rejects``, and the load checks
that the numbers add up: rows in = rows out + rejects.  More rejects than allowed (none by
default) fail the load; a layer set whose load fails is not published.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskmart.functions.columns import staged_names
from riskmart.operators import staging as st
from riskmart.operators.column_types import merged, narrowest, type_counts
from riskmart.plans.pipeline import RAW_FILES, Layers, build_layers
from riskmart.schema import IDENTITY_TYPES, TRANSACTION_TYPES
from riskmart.session import join_path
from riskmart.sources.csv import read_raw_checked
from riskmart.sources.tables import LayerStore

SPLITS = ("train", "test")
REPORT = "table_name string, split string, rows_in bigint, rows_out bigint, rejects bigint"


class LoadRejected(ValueError):
    """More records were rejected than the load allows."""


def unlisted_types(raws: list[DataFrame], types: dict[str, str]) -> dict[str, str]:
    """Staged name -> type of the columns that no layout lists, over all files of one table."""
    counts = []
    for raw in raws:
        found = type_counts(raw, st.unlisted(raw, types))
        names = staged_names(found)
        counts.append({names[c]: n for c, n in found.items()})
    return {name: narrowest(n) for name, n in merged(*counts).items()}


def _load(store: LayerStore, name: str, checked: DataFrame) -> tuple[dict[str, int], DataFrame]:
    """Write the accepted rows as layer ``name``; rows in for each split, and the rejects (not yet read)."""
    seen = Observation(f"load {name}")
    ok = F.col(st.REASON).isNull()
    counted = checked.observe(seen, *(F.count_if(F.col("split") == s).alias(f"in_{s}") for s in SPLITS),
                              *(F.count_if((F.col("split") == s) & ok).alias(f"out_{s}") for s in SPLITS))
    store.write(name, st.accepted(counted), "split")
    found = seen.get
    none = all(found[f"in_{s}"] == found[f"out_{s}"] for s in SPLITS)
    rejects = st.rejected(checked).select(F.lit(name).alias("table_name"), *st.REJECT_COLUMNS)
    # the files are read again for the rejects only where there are any
    return {s: found[f"in_{s}"] for s in SPLITS}, rejects.limit(0) if none else rejects


def load_csv(spark: SparkSession, store: LayerStore, raw_dir: str, max_rejects: int = 0) -> None:
    """Write ``stg_transactions``, ``stg_identity``, ``load_rejects`` and ``load_report`` from the four raw files."""
    raw = {key: read_raw_checked(spark, join_path(raw_dir, file)) for key, file in RAW_FILES.items()}
    plans = [("stg_transactions", "transaction", st.checked_transactions, TRANSACTION_TYPES),
             ("stg_identity", "identity", st.checked_identity, IDENTITY_TYPES)]
    rows_in, rejects = {}, []
    for name, kind, stage, types in plans:
        parts = [raw[f"{s}_{kind}"] for s in SPLITS]
        rows_in[name], found = _load(store, name, stage(*parts, unlisted_types(parts, types)))
        rejects.append(found)
    written = store.write("load_rejects", reduce(DataFrame.unionByName, rejects))
    out = reduce(DataFrame.unionByName, (store.read(name).select(F.lit(name).alias("table_name"), "split")
                                         for name in rows_in))
    count = lambda df: {(r[0], r[1]): r[2] for r in df.groupBy("table_name", "split").count().collect()}
    rows_out, rejected = count(out), count(written)          # two tables, two splits
    report = [(name, s, n, rows_out.get((name, s), 0), rejected.get((name, s), 0))
              for name, by_split in rows_in.items() for s, n in by_split.items()]
    store.write("load_report", spark.createDataFrame(report, REPORT).coalesce(1))
    for name, s, n_in, n_out, n_rejected in report:
        if n_in != n_out + n_rejected:
            raise RuntimeError(f"{name}, {s}: {n_in} rows in, but {n_out} out and {n_rejected} rejected")
    total = sum(r[4] for r in report)
    if total > max_rejects:
        why = [f"{r['table_name']} {r['split']}: {r['reason']}" for r in
               written.orderBy("table_name", "split", "reason").limit(5).collect()]
        raise LoadRejected(f"{total} records rejected, {max_rejects} allowed; first: " + " | ".join(why))


def build_csv_layers(spark: SparkSession, store: LayerStore, raw_dir: str, max_rejects: int = 0, **options) -> Layers:
    """Load the raw files and build every layer on them."""
    load_csv(spark, store, raw_dir, max_rejects)
    return build_layers(store, store.read("stg_transactions"), store.read("stg_identity"), staged=True, **options)
