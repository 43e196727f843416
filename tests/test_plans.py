"""Physical-plan properties that matter at scale, checked on the real plans."""

import pytest

from riskmart.plans.queries import REGISTRY
from tests.conftest import SF001


def _plan(df) -> str:
    # Final plan after adaptive re-planning is not needed: these are static properties.
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: _plan(fn(spark, SF001)) for name, fn in REGISTRY.items()}


def test_no_cartesian_or_nested_loop_joins(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_no_python_udfs(plans):
    for name, plan in plans.items():
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_train_reads_prune_the_split_partition(plans):
    plan = plans["recent_transactions"]
    assert "PartitionFilters: [isnotnull(split" in plan and "(split#" in plan
    assert "ReadSchema: struct<transaction_id:bigint,is_fraud:boolean,transaction_dt:bigint" in plan


def test_history_limits_rows_before_the_shuffle(plans):
    lines = plans["recent_transactions"].splitlines()
    # each task cuts a card's rows before the shuffle, and once more after it, below the join with candidates
    exchange = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning(card1" in l)
    assert any("WindowGroupLimit" in l for l in lines[exchange + 1:])
    join = max(i for i, l in enumerate(lines[:exchange]) if "BroadcastHashJoin" in l)
    assert any("WindowGroupLimit [card1" in l for l in lines[join:exchange])


def test_many_candidates_on_a_hot_card_do_not_multiply_its_rows(spark):
    from pyspark.sql import functions as F

    from riskmart.operators.investigate import recent_history
    from riskmart.plans.catalog import layers_for
    enriched = layers_for(spark, SF001).enriched.withColumn("card1", F.lit(1).cast("bigint"))
    train = enriched.where("split = 'train'")
    top = train.orderBy(F.desc("transaction_dt"), F.desc("transaction_id")).limit(40).select("transaction_id")
    cands = spark.createDataFrame([(r[0], 1, i) for i, r in enumerate(top.collect())],
                                  "transaction_id long, card1 long, candidate_rank int")
    found = recent_history(cands, enriched, 10)
    rows = {}
    for r in found.orderBy("candidate_rank", "position").collect():
        rows.setdefault(r["candidate_id"], []).append(r["transaction_id"])
    order = [r[0] for r in cands.orderBy("candidate_rank").collect()]
    assert rows == {c: [x for x in order if x != c][:10] for c in order}


def test_hot_card_is_split_in_scoring(spark, tmp_dir):
    import os

    from pyspark.sql import functions as F

    from riskmart.operators.scoring import card_average, score
    from riskmart.plans.catalog import layers_for
    from riskmart.plans.pipeline import SCORING_COLUMNS
    layers = layers_for(spark, SF001)
    path = os.path.join(tmp_dir, "hot")
    hot = layers.enriched.withColumn("card1", F.when(F.col("transaction_id") % 3 == 0, -5).otherwise(
        F.col("transaction_id")).cast("bigint")).crossJoin(spark.range(8).select(F.col("id").alias("copy")))
    hot.drop("copy").write.parquet(path + "/rows")
    hot = spark.read.parquet(path + "/rows")
    card_average(hot).write.parquet(path + "/averages")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        scored = score(hot, layers.domain_mart, averages=spark.read.parquet(path + "/averages"))
        assert scored.columns == SCORING_COLUMNS and len(scored.collect()) == 80_000
        assert "skew=true" in _plan(scored)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_top_n_is_take_ordered(plans):
    assert "TakeOrderedAndProject" in plans["investigation_candidates"]


def test_aggregates_are_partial_before_shuffle(plans):
    for name in ["agg_fraud_by_email_domain", "card_average", "scoring_validation",
                 "fraud_rate_by_hour", "customer_context", "case_note_first_valid"]:
        plan = plans[name]
        assert "partial_" in plan or "Aggregate" not in plan, name


def test_candidate_side_is_broadcast(plans):
    for name in ["customer_context", "recent_transactions"]:
        assert "BroadcastExchange" in plans[name], name


def test_dashboard_worksheets_scan_the_extract(plans):
    for name in ["kpi_overview", "fraud_rate_by_hour", "fraud_rate_by_product",
                 "investigation_queue"]:
        plan = plans[name]
        assert "Join" not in plan and "FileScan parquet" in plan, name


def test_windowed_history_is_a_hash_join(spark):
    from riskmart.operators.investigate import card_statistics, recent_history
    from riskmart.plans.catalog import layers_for
    from riskmart.plans.queries import _candidates
    L = layers_for(spark, SF001)
    cands = _candidates(spark, SF001)
    for df in (card_statistics(cands, L.enriched, lookback_seconds=30 * 86400, only_before=True),
               recent_history(cands, L.enriched, 10, lookback_seconds=30 * 86400)):
        plan = _plan(df)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert "Exchange hashpartitioning(transaction_id" not in plan
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_bucketed_layers_join_without_shuffle(spark, tmp_dir):
    import uuid

    from riskmart.operators.casenotes import empty_notes
    from riskmart.operators.enrich import enrich
    from riskmart.operators.reporting import report_base
    from riskmart.plans.pipeline import build_layers
    from riskmart.sources.events import events_to_identity, staged_from_events
    from riskmart.sources.tables import CatalogLayerStore
    from tests.conftest import SF0001

    store = CatalogLayerStore(spark, f"riskmart_{uuid.uuid4().hex[:8]}", tmp_dir, buckets=8)
    txn, _ = staged_from_events(spark, SF0001)
    layers = build_layers(store, txn, identity_from_transactions=events_to_identity)
    assert layers.enriched.count() == 1000 and layers.scoring.count() == 1000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(enrich(layers.stg_transactions, layers.stg_identity))
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        base = report_base(layers.fact, empty_notes(spark), layers.scoring)
        plan = _plan(base)
        smj = plan.split("SortMergeJoin", 1)[1]
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in smj
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partitioned_layers_are_written_without_a_sort(spark, tmp_dir, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    from riskmart.session import WRITERS
    from riskmart.sources.tables import LayerStore
    before, seen, plain = spark.conf.get(WRITERS), [], DataFrameWriter.parquet

    def parquet(writer, path):
        seen.append(int(spark.conf.get(WRITERS)))
        plain(writer, path)
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    rows = spark.sql("SELECT id, CASE id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'test' END AS split FROM range(50)")
    try:
        for own in (0, 7):                      # a session without our settings, and one of a value of its own
            spark.conf.set(WRITERS, own)
            written = LayerStore(spark, f"{tmp_dir}/{own}").write("rows", rows, "split")
            assert sorted(map(str, written.collect())) == sorted(map(str, rows.collect()))
            assert int(spark.conf.get(WRITERS)) == own
    finally:
        spark.conf.set(WRITERS, before)
    assert seen == [4, 7]


def test_identity_that_compresses_well_is_not_broadcast(spark, tmp_dir):
    from pyspark.sql import functions as F

    from riskmart.operators.enrich import enrich
    from riskmart.schema import IDENTITY_TYPES, TRANSACTION_TYPES
    from riskmart.sources.conform import conform
    ids = spark.range(100_001).select(F.col("id").alias("transaction_id"), F.lit("train").alias("split"))
    conform(ids, IDENTITY_TYPES).write.parquet(f"{tmp_dir}/identity")
    identity = spark.read.parquet(f"{tmp_dir}/identity")
    transactions = conform(ids, TRANSACTION_TYPES)
    assert "SortMergeJoin" in _plan(enrich(transactions, identity))
    assert "BroadcastHashJoin" in _plan(enrich(transactions, identity.limit(1_000)))
