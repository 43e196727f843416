"""Layer invariants and the published shape of the scoring result (FIXTURES.md section 3)."""

import pytest
from pyspark.sql import functions as F

from riskmart.plans.catalog import layers_for
from tests.conftest import SF001, SF0001


@pytest.fixture(scope="module")
def layers(spark):
    return layers_for(spark, SF001)


def test_staging_counts(layers):
    txn = layers.stg_transactions
    assert txn.count() == 10000
    assert txn.where("split = 'train'").count() == 6996
    assert txn.where("split = 'train' AND is_fraud").count() == 419
    assert txn.where("split = 'test'").count() == 3004
    assert txn.where("split = 'test' AND is_fraud IS NOT NULL").count() == 0
    assert layers.stg_identity.count() == 2500


def test_layer_invariants(layers):
    n = layers.stg_transactions.count()
    assert layers.enriched.count() == n                  # left join on a unique key
    assert layers.scoring.count() == n
    assert layers.fact.count() == layers.stg_transactions.where("split = 'train'").count()
    assert layers.enriched.columns[-3:] == ["hour_of_day", "day_of_week", "amount_bucket"]
    assert len(layers.enriched.columns) == 52
    hours = layers.enriched.agg(F.min("hour_of_day"), F.max("hour_of_day"),
                                F.min("day_of_week"), F.max("day_of_week")).first()
    assert tuple(hours) == (0, 24, 0, 7)


def test_score_distribution_matches_fixture(layers):
    got = {r["risk_score"]: (r["transactions"], r["fraud_count"])
           for r in layers.scoring.where("split = 'train'").groupBy("risk_score")
           .agg(F.count(F.lit(1)).alias("transactions"),
                F.count_if("is_fraud").alias("fraud_count")).collect()}
    assert got == {0: (3741, 137), 25: (2604, 146), 50: (586, 97), 75: (64, 38), 100: (1, 1)}


def test_fraud_rate_rises_with_score(spark):
    from riskmart.plans.queries import REGISTRY
    rows = sorted((r["risk_score"], r["fraud_rate"])
                  for r in REGISTRY["scoring_validation"](spark, SF001).collect())
    rates = [r for s, r in rows if s <= 75]
    assert rates == sorted(rates)


def test_domain_mart(layers):
    mart = {r["domain"]: r for r in layers.domain_mart.collect()}
    assert mart["mail.com"]["fraud_rate"] == 21.4888
    assert mart["aim.com"]["fraud_rate"] == 14.095
    assert mart[None]["total_transactions"] == 699 and mart[None]["fraud_rate"] == 3.0043
    assert all(r["total_transactions"] >= 100 for r in mart.values())


def test_min_rows_boundary(spark):
    from riskmart.operators.marts import email_domain_mart
    rows = [(i, i < 20, 10.0, "a.com" if i < 99 else ("b.com" if i < 199 else None))
            for i in range(299)]
    fact = spark.createDataFrame(rows, "transaction_id bigint, is_fraud boolean, "
                                       "transaction_amt double, p_emaildomain string")
    mart = {r["domain"]: r["total_transactions"] for r in email_domain_mart(fact).collect()}
    assert mart == {"b.com": 100, None: 100}            # a.com has 99 rows


def test_rule_boundaries(layers):
    s = layers.scoring
    assert s.where("c1 = 3").count() > 0
    assert s.where("c1 = 3 AND velocity_flag = 1").count() == 0        # strictly above 3
    assert s.where("c1 > 3 AND velocity_flag = 0").count() == 0
    assert s.where("hour_of_day IN (1, 5) AND time_anomaly_flag = 0").count() == 0
    assert s.where("hour_of_day IN (0, 6) AND time_anomaly_flag = 1").count() == 0
    assert s.where("card1 IS NULL AND avg_card1_amt IS NOT NULL").count() == 0
    assert s.where("card1 IS NULL AND amount_anomaly_flag = 1").count() == 0
    assert s.where("p_emaildomain IS NULL AND email_risk_flag = 1").count() == 0
    assert s.where("risk_score <> 25 * (velocity_flag + amount_anomaly_flag + "
                   "time_anomaly_flag + email_risk_flag)").count() == 0


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.columns == ["risk_score", "transactions", "fraud_count", "fraud_rate"]
    assert df.count() > 0
    # At sf0.001 no domain is risky, so no score of 100.
    assert layers_for(spark, SF0001).scoring.where("email_risk_flag = 1").count() == 0


def test_floor_hour_mode_gives_clock_hours(spark, tmp_dir):
    from riskmart.plans.pipeline import build_layers
    from riskmart.sources.events import events_to_identity, staged_from_events
    from riskmart.sources.tables import LayerStore
    txn, _ = staged_from_events(spark, SF0001)
    layers = build_layers(LayerStore(spark, tmp_dir), txn,
                          identity_from_transactions=events_to_identity, hour_mode="floor")
    r = layers.enriched.agg(F.min("hour_of_day"), F.max("hour_of_day"),
                            F.max("day_of_week")).first()
    assert r[0] >= 0 and r[1] <= 23 and r[2] <= 6


def test_empty_input_builds_readable_layers(spark, tmp_dir):
    from riskmart.operators import quality as qa
    from riskmart.plans.pipeline import build_layers
    from riskmart.schema import TRANSACTION_NULL_REPORT
    from riskmart.sources.events import events_to_identity, events_to_transactions, read_events
    from riskmart.sources.tables import LayerStore
    ev = read_events(spark, SF0001).where("false")
    layers = build_layers(LayerStore(spark, tmp_dir), events_to_transactions(ev),
                          identity_from_transactions=events_to_identity)
    assert layers.scoring.count() == 0 and layers.domain_mart.count() == 0
    # Another store instance (as another session would) reads the empty partitioned layer.
    fresh = LayerStore(spark, tmp_dir)
    enriched = fresh.read("int_transactions_enriched")
    assert "transaction_id" in enriched.columns and enriched.count() == 0
    assert qa.train_fraud_rate(layers.stg_transactions).first()[0] == 0
    assert qa.null_counts(layers.stg_transactions, TRANSACTION_NULL_REPORT).count() == 13
