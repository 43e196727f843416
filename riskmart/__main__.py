"""Command line: the pipeline steps as Spark jobs.

  python -m riskmart load    --raw-dir RAW --work DIR     stage the four CSVs, build layers, report
  python -m riskmart events  --sf-dir SF  --work DIR      same, from the driver's events table
  python -m riskmart prompts --work DIR [--limit 5]       candidates, context and prompts -> table
  python -m riskmart notes   --work DIR --answers PATH    answers -> first valid -> case notes
  python -m riskmart export  --work DIR --out DIR         dashboard CSV files

Results are written as tables under ``--work``; the console shows small
summaries with ``show()`` only.
"""

from __future__ import annotations

import argparse

from riskmart.session import build_session, join_path


def _report(layers) -> None:
    from riskmart.operators import quality as qa
    from riskmart.plans.pipeline import layer_row_counts
    from riskmart.schema import IDENTITY_NULL_REPORT, TRANSACTION_NULL_REPORT
    txn, ident = layers.stg_transactions, layers.stg_identity
    layer_row_counts(layers).orderBy("step").show(truncate=False)
    qa.split_row_counts({"stg_transactions": txn, "stg_identity": ident}).show()
    qa.null_counts(txn, TRANSACTION_NULL_REPORT).orderBy("position").show(50)
    qa.null_counts(ident, IDENTITY_NULL_REPORT).orderBy("position").show(50)
    qa.identity_coverage(txn, ident).show()
    qa.train_fraud_rate(txn).show()
    qa.type_check(txn).show(truncate=False)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="riskmart")
    p.add_argument("command", choices=["load", "events", "prompts", "notes", "export"])
    p.add_argument("--raw-dir")
    p.add_argument("--sf-dir")
    p.add_argument("--work", required=True, help="shared folder for the written tables")
    p.add_argument("--limit", type=int, default=5)
    p.add_argument("--answers", help="answer table (parquet: transaction_id, attempt, raw_response)")
    p.add_argument("--out")
    p.add_argument("--max-rejects", type=int, default=0, help="raw records a load may reject before it fails")
    p.add_argument("--master")
    p.add_argument("--catalog-db", help="keep layers as catalog tables, bucketed by "
                                        "transaction_id (needs a metastore across runs)")
    p.add_argument("--buckets", type=int, default=64)
    p.add_argument("--hour-mode", choices=["round", "floor"], default="round",
                   help="round: hours 0..24 as the source SQL; floor: clock hours 0..23")
    a = p.parse_args(argv)

    from riskmart.operators import casenotes as cn
    from riskmart.plans.batch import review_inputs, review_outcome
    from riskmart.plans.load import build_csv_layers
    from riskmart.plans.pipeline import build_layers, export_dashboard
    from riskmart.sources.events import events_to_identity, staged_from_events
    from riskmart.plans.pipeline import Layers
    from riskmart.sources.layer_sets import LayerSets
    from riskmart.sources.tables import CatalogLayerStore, LayerStore
    from riskmart.sources.notes import NoteTable

    spark = build_session(a.master)
    layers_root = join_path(a.work, "layers")

    def build(store):
        if a.command == "load":
            layers = build_csv_layers(spark, store, a.raw_dir, a.max_rejects, hour_mode=a.hour_mode)
            store.read("load_report").show()
        else:
            txn, _ = staged_from_events(spark, a.sf_dir)
            layers = build_layers(store, txn, identity_from_transactions=events_to_identity,
                                  hour_mode=a.hour_mode)
        return layers

    if a.command in ("load", "events"):
        # path layers become visible all at once; catalog tables are replaced one by one
        _report(build(CatalogLayerStore(spark, a.catalog_db, layers_root, a.buckets)) if a.catalog_db
                else Layers(LayerSets(spark, layers_root).build(build)))
        return
    store = (CatalogLayerStore(spark, a.catalog_db, layers_root, a.buckets) if a.catalog_db
             else LayerSets(spark, layers_root).current())
    if store is None:
        p.error(f"no layers under {layers_root}: run load or events first")
    layers = Layers(store)
    review = store if a.catalog_db else LayerStore(spark, join_path(a.work, "review"))
    if a.command == "prompts":
        inputs = review_inputs(layers, a.limit, store=review)          # writes review_candidates
        review.write("review_prompts", inputs.prompts)
        review.read("review_prompts").orderBy("candidate_rank").select("transaction_id").show()
    elif a.command == "notes":
        cands = review.read("review_candidates")
        notes = NoteTable(spark, join_path(a.work, "case_notes"))
        out = review_outcome(cands, spark.read.parquet(a.answers), notes.latest())
        notes.upsert(cn.notes_from_results(out.results))     # rewrites the touched buckets only
        out.summary.show(truncate=False)
        cn.label_counts(out.results, "risk_assessment").show()
        cn.label_counts(out.results, "recommended_action").show()
    elif a.command == "export":
        notes = NoteTable(spark, join_path(a.work, "case_notes")).latest()
        for name, path in export_dashboard(layers, notes, a.out).items():
            print(f"{name}: {path}")


if __name__ == "__main__":
    main()
