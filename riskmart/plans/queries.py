"""The registered queries, each ``fn(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.operators import casenotes as cn
from riskmart.operators import investigate as inv
from riskmart.operators import quality as qa
from riskmart.operators import reporting as rp
from riskmart.operators import scoring as sc
from riskmart.operators.marts import ordered_domain_mart
from riskmart.operators.positions import with_position
from riskmart.plans.batch import write_report_base
from riskmart.plans.catalog import QueryFn, layers_for
from riskmart.plans.fixtures import answers_for
from riskmart.plans.load import build_csv_layers, load_csv
from riskmart.plans.pipeline import RAW_FILES, Layers, layer_row_counts
from riskmart.plans.review_run import ReviewRun
from riskmart.schema import FACT_COLUMNS, IDENTITY_NULL_REPORT, SCORING_COLUMNS, TRANSACTION_NULL_REPORT
from riskmart.session import join_path
from riskmart.sources.csv import CASE_NOTE_SCHEMA, export_csv, import_csv
from riskmart.sources.events import staged_from_events
from riskmart.sources.layer_sets import LayerSets
from riskmart.sources.notes import NoteTable
from riskmart.sources.raw_files import raw_files, write_faulty, write_raw

BATCH_SIZE = 20          # one review batch, as the source's showcase run
HISTORY_ROWS = 10
_ONCE_LOCK = threading.RLock()

REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


def _once(spark, sf_dir, name: str, build, order=None) -> DataFrame:
    """Table ``name`` next to the layers, written by ``build()`` on first use, then read."""
    store = layers_for(spark, sf_dir).store
    with _ONCE_LOCK:
        if not store.exists(name):
            store.write(name, build())
    return store.read(name, order)


def _layer(name: str) -> QueryFn:
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        return layers_for(spark, sf_dir).table(name)
    fn.__name__ = name
    return fn


for _name in ("stg_transactions", "stg_identity", "int_transactions_enriched",
              "fct_fraud_analysis", "rule_based_scoring"):
    REGISTRY[_name] = _layer(_name)


@query("agg_fraud_by_email_domain")
def agg_fraud_by_email_domain(spark, sf_dir):
    return ordered_domain_mart(layers_for(spark, sf_dir).domain_mart)


@query("card_average")
def card_average(spark, sf_dir):
    return sc.card_average(layers_for(spark, sf_dir).enriched)


@query("high_risk_domains")
def high_risk_domains(spark, sf_dir):
    return sc.high_risk_domains(layers_for(spark, sf_dir).domain_mart)


@query("scoring_validation")
def scoring_validation(spark, sf_dir):
    return sc.scoring_validation(layers_for(spark, sf_dir).scoring)


@query("rule_lift")
def rule_lift(spark, sf_dir):
    return sc.rule_lift(layers_for(spark, sf_dir).scoring)


@query("pipeline_row_counts")
def pipeline_row_counts(spark, sf_dir):
    return layer_row_counts(layers_for(spark, sf_dir))


# ---------------------------------------------------------------------------
# Quality report
# ---------------------------------------------------------------------------


@query("split_row_counts")
def split_row_counts(spark, sf_dir):
    L = layers_for(spark, sf_dir)
    return qa.split_row_counts({"stg_transactions": L.stg_transactions,
                                "stg_identity": L.stg_identity})


@query("null_rates_transactions")
def null_rates_transactions(spark, sf_dir):
    return qa.null_counts(layers_for(spark, sf_dir).stg_transactions, TRANSACTION_NULL_REPORT)


@query("null_rates_identity")
def null_rates_identity(spark, sf_dir):
    return qa.null_counts(layers_for(spark, sf_dir).stg_identity, IDENTITY_NULL_REPORT)


@query("identity_coverage")
def identity_coverage(spark, sf_dir):
    L = layers_for(spark, sf_dir)
    return qa.identity_coverage(L.stg_transactions, L.stg_identity)


@query("train_fraud_rate")
def train_fraud_rate(spark, sf_dir):
    return qa.train_fraud_rate(layers_for(spark, sf_dir).stg_transactions)


@query("type_check")
def type_check(spark, sf_dir):
    return qa.type_check(layers_for(spark, sf_dir).stg_transactions)


# ---------------------------------------------------------------------------
# Investigation and case notes (a batch of the top 20, as the source's showcase run)
# ---------------------------------------------------------------------------


def _candidates(spark, sf_dir):
    """The batch's candidate rows, fetched once before review (written as a table)."""
    L = layers_for(spark, sf_dir)
    return _once(spark, sf_dir, "review_candidates",
                 lambda: inv.candidates(L.scoring, L.enriched, BATCH_SIZE),
                 inv.CANDIDATE_COLUMNS + ["candidate_rank"])


def _answers(spark, sf_dir, shift: int = 0):
    """The review answers of a run, written once as a table (answers arrive as files)."""
    return _once(spark, sf_dir, f"review_answers_{shift}",
                 lambda: answers_for(_candidates(spark, sf_dir), shift))


def _first_valid(spark, sf_dir, shift: int = 0):
    cands = _candidates(spark, sf_dir)
    parsed = cn.parse_responses(_answers(spark, sf_dir, shift))
    return cands, cn.first_valid(parsed, cands.select("transaction_id"))


def _results(spark, sf_dir, shift: int = 0):
    """Candidates and their review results (first valid answer), the results written once."""
    cands = _candidates(spark, sf_dir)
    return cands, _once(spark, sf_dir, f"review_results_{shift}",
                        lambda: _first_valid(spark, sf_dir, shift)[1])


def _notes(spark, sf_dir):
    """The case-note table after the first review run (written once, like the source's table)."""
    def build():
        _, results = _results(spark, sf_dir)
        return cn.upsert_case_notes(cn.empty_notes(spark), cn.notes_from_results(results))
    return _once(spark, sf_dir, "case_notes", build, cn.NOTE_COLUMNS)


@query("investigation_candidates")
def investigation_candidates(spark, sf_dir):
    L = layers_for(spark, sf_dir)
    return inv.candidates(L.scoring, L.enriched, BATCH_SIZE)


@query("customer_context")
def customer_context(spark, sf_dir):
    L = layers_for(spark, sf_dir)
    return inv.card_statistics(_candidates(spark, sf_dir), L.enriched)


@query("recent_transactions")
def recent_transactions(spark, sf_dir):
    L = layers_for(spark, sf_dir)
    return inv.recent_history(_candidates(spark, sf_dir), L.enriched, HISTORY_ROWS)


@query("investigation_prompts")
def investigation_prompts(spark, sf_dir):
    L = layers_for(spark, sf_dir)
    cands = _candidates(spark, sf_dir)
    return inv.prompts(cands, inv.card_statistics(cands, L.enriched),
                       inv.recent_history(cands, L.enriched, HISTORY_ROWS))


@query("case_note_parse")
def case_note_parse(spark, sf_dir):
    return cn.parse_responses(_answers(spark, sf_dir))


@query("case_note_first_valid")
def case_note_first_valid(spark, sf_dir):
    return _first_valid(spark, sf_dir)[1]


@query("case_notes_upsert")
def case_notes_upsert(spark, sf_dir):
    """A second review run (other answer shapes) upserted over the first run's notes."""
    first = _notes(spark, sf_dir)
    _, rerun = _results(spark, sf_dir, shift=3)
    merged = cn.upsert_case_notes(first, cn.notes_from_results(rerun))
    return merged.drop("created_at")


@query("case_note_table")
def case_note_table(spark, sf_dir):
    """Both review runs upserted into a bucketed note table: its rows, and whether each kept its first time."""
    store = layers_for(spark, sf_dir).store
    table = NoteTable(spark, store.path(f"note-tables/{uuid.uuid4().hex}"), buckets=16)
    table.upsert(cn.notes_from_results(_results(spark, sf_dir)[1]))
    first = table.latest().select(F.col("transaction_id").alias("first_id"), F.col("created_at").alias("first_at"))
    table.upsert(cn.notes_from_results(_results(spark, sf_dir, shift=3)[1]))
    now = table.latest()
    kept = F.when(F.col("first_id").isNull(), F.col("created_at").isNotNull()).otherwise(
        F.col("created_at") == F.col("first_at"))
    return now.join(first, F.col("transaction_id") == F.col("first_id"), "left").select(
        *cn.UPSERT_COLUMNS, F.col("first_id").isNotNull().alias("known_before"), kept.alias("created_at_kept"))


@query("review_batch")
def review_batch(spark, sf_dir):
    """A whole review run over its tables, cut off after the first round of answers and resumed: every candidate's state."""
    store = layers_for(spark, sf_dir).store
    root, name = store.path("review-runs"), uuid.uuid4().hex
    notes = NoteTable(spark, store.path(f"review-runs/{name}/notes"), buckets=16)
    ReviewRun(spark, root, name, notes).start(layers_for(spark, sf_dir), BATCH_SIZE, HISTORY_ROWS)
    for _ in range(3):                       # each round is a process of its own: it knows the folder only
        run = ReviewRun(spark, root, name, notes)
        asked = run.open_prompts().select("transaction_id", "attempt")
        run.take(_answers(spark, sf_dir).join(asked, ["transaction_id", "attempt"]))
    return ReviewRun(spark, root, name, notes).state()


@query("batch_failed_candidates")
def batch_failed_candidates(spark, sf_dir):
    return cn.failed_candidates(*_results(spark, sf_dir))


@query("batch_summary")
def batch_summary(spark, sf_dir):
    cands, results = _results(spark, sf_dir)
    return cn.batch_summary(cands, results)


@query("assessment_counts")
def assessment_counts(spark, sf_dir):
    return cn.label_counts(_results(spark, sf_dir)[1], "risk_assessment")


@query("action_counts")
def action_counts(spark, sf_dir):
    return cn.label_counts(_results(spark, sf_dir)[1], "recommended_action")


# ---------------------------------------------------------------------------
# Dashboard
# ---------------------------------------------------------------------------


def _base(spark, sf_dir):
    """The dashboard extract: one big join written once, then scanned by every worksheet."""
    L = layers_for(spark, sf_dir)
    with _ONCE_LOCK:
        if not L.store.exists("report_base"):
            write_report_base(L.store, L.fact, _notes(spark, sf_dir), L.scoring)
    return L.store.read("report_base")


@query("reporting_join")
def reporting_join(spark, sf_dir):
    return _base(spark, sf_dir).drop("created_at")


@query("kpi_overview")
def kpi_overview(spark, sf_dir):
    return rp.kpis(_base(spark, sf_dir))


@query("fraud_rate_by_hour")
def fraud_rate_by_hour(spark, sf_dir):
    return rp.fraud_rate_by_hour(_base(spark, sf_dir))


@query("fraud_rate_by_card_network")
def fraud_rate_by_card_network(spark, sf_dir):
    return rp.fraud_rate_by_card_network(_base(spark, sf_dir))


@query("fraud_rate_by_product")
def fraud_rate_by_product(spark, sf_dir):
    return rp.fraud_rate_by_product(_base(spark, sf_dir))


@query("fraud_rate_by_score_band")
def fraud_rate_by_score_band(spark, sf_dir):
    return rp.fraud_rate_by_score_band(_base(spark, sf_dir))


@query("scoring_performance")
def scoring_performance(spark, sf_dir):
    return rp.scoring_performance(_base(spark, sf_dir))


@query("investigation_queue")
def investigation_queue(spark, sf_dir):
    return rp.investigation_queue(_base(spark, sf_dir), min_score=50)


@query("transaction_deep_dive")
def transaction_deep_dive(spark, sf_dir):
    """Deep dive of every reviewed transaction (the ids that have a case note)."""
    notes = _notes(spark, sf_dir).select(F.col("transaction_id").try_cast("bigint")
                                         .alias("transaction_id"))
    return rp.deep_dive(_base(spark, sf_dir), notes)


# ---------------------------------------------------------------------------
# Dashboard export: mart, scoring and case notes through CSV and back
# ---------------------------------------------------------------------------


def _through_csv(spark, sf_dir, df: DataFrame) -> DataFrame:
    """``df`` written as CSV into a folder of its own and read back with its types."""
    path = layers_for(spark, sf_dir).store.path(f"exports/{uuid.uuid4().hex}")
    export_csv(df, path)
    return import_csv(spark, path, df.schema)


@query("csv_round_trip")
def csv_round_trip(spark, sf_dir):
    """Case notes (multi-line, quoted answer text) written as CSV and read back typed."""
    path = layers_for(spark, sf_dir).store.path(f"exports/{uuid.uuid4().hex}")
    export_csv(_notes(spark, sf_dir), path)
    return import_csv(spark, path, CASE_NOTE_SCHEMA).drop("created_at")


@query("csv_export_fact")
def csv_export_fact(spark, sf_dir):
    return _through_csv(spark, sf_dir, layers_for(spark, sf_dir).fact.select(*FACT_COLUMNS))


@query("csv_export_scoring")
def csv_export_scoring(spark, sf_dir):
    return _through_csv(spark, sf_dir, layers_for(spark, sf_dir).scoring.select(*SCORING_COLUMNS))


@query("csv_export_notes")
def csv_export_notes(spark, sf_dir):
    """Case notes through CSV, and whether the time of each came back to the microsecond."""
    notes = _notes(spark, sf_dir)
    before = notes.select(F.col("transaction_id").alias("note_id"), F.col("created_at").alias("written_at"))
    back = _through_csv(spark, sf_dir, notes)
    return back.join(before, F.col("transaction_id") == F.col("note_id")).select(
        *cn.UPSERT_COLUMNS, (F.col("created_at") == F.col("written_at")).alias("created_at_exact"))


# ---------------------------------------------------------------------------
# Ordered results with their positions
# ---------------------------------------------------------------------------


def _positions(spark, sf_dir, df: DataFrame, *order) -> DataFrame:
    return with_position(df, list(order), layers_for(spark, sf_dir).store, f"positions/{uuid.uuid4().hex}")


@query("ordered_domain_mart")
def ordered_domains(spark, sf_dir):
    return _positions(spark, sf_dir, layers_for(spark, sf_dir).domain_mart.select("domain", "fraud_rate"),
                      F.desc_nulls_last("fraud_rate"), F.asc_nulls_last("domain"))


@query("ordered_split_counts")
def ordered_split_counts(spark, sf_dir):
    return _positions(spark, sf_dir, split_row_counts(spark, sf_dir), F.asc("table_name"), F.asc("split"))


@query("ordered_identity_coverage")
def ordered_identity_coverage(spark, sf_dir):
    return _positions(spark, sf_dir, identity_coverage(spark, sf_dir), F.asc("split"))


def _bars(name: str, rates, dimension: str) -> None:
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _positions(spark, sf_dir, rates(_base(spark, sf_dir)), F.desc_nulls_last("fraud_rate"),
                          F.asc_nulls_first(dimension))
    REGISTRY[name] = fn


_bars("ordered_card_networks", rp.fraud_rate_by_card_network, "card4")
_bars("ordered_products", rp.fraud_rate_by_product, "product_cd")
_bars("ordered_score_bands", rp.fraud_rate_by_score_band, "score_band")


@query("ordered_investigation_queue")
def ordered_investigation_queue(spark, sf_dir):
    rows = rp.investigation_queue(_base(spark, sf_dir), min_score=50)
    return _positions(spark, sf_dir, rows, F.desc_nulls_last("risk_score"), F.desc_nulls_last("transaction_amt"),
                      *(F.asc_nulls_first(c) for c in rp.QUEUE_COLUMNS[2:]))


@query("ordered_labels")
def ordered_labels(spark, sf_dir):
    results = _results(spark, sf_dir)[1]
    labels = cn.label_counts(results, "risk_assessment").select(F.lit("risk_assessment").alias("field"), "label", "count")
    return _positions(spark, sf_dir, labels.unionByName(cn.label_counts(results, "recommended_action").select(
        F.lit("recommended_action").alias("field"), "label", "count")), F.asc("field"), F.asc_nulls_first("label"))


# ---------------------------------------------------------------------------
# Raw CSV files: the load as a user runs it
# ---------------------------------------------------------------------------


def _raw_dir(spark, sf_dir, name: str, write) -> str:
    """A folder with the four raw files of the events, written once next to the layers."""
    path = layers_for(spark, sf_dir).store.path(name)
    for key, df in raw_files(*staged_from_events(spark, sf_dir)).items():
        write(df, join_path(path, RAW_FILES[key]))
    return path


def _csv_set(spark, sf_dir, name: str, build) -> Layers:
    sets = LayerSets(spark, layers_for(spark, sf_dir).store.path(name))
    with _ONCE_LOCK:
        return Layers(sets.current_or_build(build))


def _csv_layers(spark, sf_dir):
    """Layers built from four raw CSV files of the events (published next to the other layers, once)."""
    return _csv_set(spark, sf_dir, "csv-layers", lambda store: build_csv_layers(
        spark, store, _raw_dir(spark, sf_dir, "raw-csv", write_raw)))


def _faulty_load(spark, sf_dir):
    """The load of raw files with records that no load can take, all of them allowed."""
    return _csv_set(spark, sf_dir, "csv-faulty", lambda store: load_csv(
        spark, store, _raw_dir(spark, sf_dir, "raw-csv-faulty", write_faulty), max_rejects=1 << 62))


@query("csv_stg_transactions")
def csv_stg_transactions(spark, sf_dir):
    return _csv_layers(spark, sf_dir).table("stg_transactions")


@query("csv_stg_identity")
def csv_stg_identity(spark, sf_dir):
    return _csv_layers(spark, sf_dir).table("stg_identity")


@query("csv_scoring_validation")
def csv_scoring_validation(spark, sf_dir):
    return sc.scoring_validation(_csv_layers(spark, sf_dir).scoring)


@query("csv_null_rates_transactions")
def csv_null_rates_transactions(spark, sf_dir):
    return qa.null_counts(_csv_layers(spark, sf_dir).table("stg_transactions"), TRANSACTION_NULL_REPORT)


@query("csv_load_report")
def csv_load_report(spark, sf_dir):
    return _faulty_load(spark, sf_dir).store.read("load_report")


@query("csv_load_rejects")
def csv_load_rejects(spark, sf_dir):
    """Every rejected record by its key's text, with its reason."""
    rejects = _faulty_load(spark, sf_dir).store.read("load_rejects")
    return rejects.select("table_name", "split", F.split("record", ",")[0].alias("key_text"), "reason")


@query("csv_faulty_transactions")
def csv_faulty_transactions(spark, sf_dir):
    """The transactions that the load of faulty files lets through."""
    return _faulty_load(spark, sf_dir).table("stg_transactions").select("split", "transaction_id", "is_fraud", "card1")
