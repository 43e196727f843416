"""Upsert semantics, batch summary and the dashboard filters."""

import time

from pyspark.sql import functions as F

from riskmart.operators.casenotes import batch_summary, empty_notes, upsert_case_notes
from riskmart.operators.reporting import deep_dive, investigation_queue

SCHEMA = ("transaction_id string, risk_assessment string, likely_pattern string, "
          "confidence double, reasoning string, recommended_action string, case_note string, "
          "raw_response string")


def _note(tid, risk, conf):
    return (tid, risk, "card_testing", conf, "r", "decline", "n", "{}")


def test_upsert_twice_keeps_first_created_at(spark):
    first = upsert_case_notes(empty_notes(spark),
                              spark.createDataFrame([_note("1", "low", 0.1),
                                                     _note("2", "high", 0.9)], SCHEMA))
    first = spark.createDataFrame(first.collect(), first.schema)        # freeze the time
    t1 = {r["transaction_id"]: r["created_at"] for r in first.collect()}
    time.sleep(1.1)
    second = upsert_case_notes(first, spark.createDataFrame(
        [_note("2", "critical", 0.7), _note("3", "medium", 0.5)], SCHEMA))
    out = {r["transaction_id"]: r for r in second.collect()}
    assert set(out) == {"1", "2", "3"}
    assert out["1"]["risk_assessment"] == "low" and out["1"]["created_at"] == t1["1"]
    assert out["2"]["risk_assessment"] == "critical" and out["2"]["confidence"] == 0.7
    assert out["2"]["created_at"] == t1["2"]                            # kept, not refreshed
    assert out["3"]["created_at"] > t1["2"]


def test_batch_summary_lists_failures_in_rank_order(spark):
    cands = spark.createDataFrame([(30, 1), (10, 2), (20, 3)], "transaction_id bigint, "
                                                               "candidate_rank int")
    results = spark.createDataFrame([(30, False), (10, True), (20, False)],
                                    "transaction_id bigint, succeeded boolean")
    r = batch_summary(cands, results).first()
    assert (r["investigated"], r["succeeded"], r["failed"], r["failed_ids"]) == (3, 1, 2, "30, 20")


def test_queue_filter_and_members(spark):
    base = spark.createDataFrame(
        [(75, 10.0, 1, 0, 1, 1, "visa"), (50, 5.0, 1, 0, 0, 1, "visa"),
         (50, 5.0, 1, 0, 0, 1, "visa"), (25, 1.0, 1, 0, 0, 0, None)],
        "risk_score int, transaction_amt double, time_anomaly_flag int, "
        "amount_anomaly_flag int, email_risk_flag int, velocity_flag int, card4 string")
    assert [r["risk_score"] for r in investigation_queue(base).collect()] == [75, 50]
    assert [r["risk_score"] for r in investigation_queue(base, members=[50]).collect()] == [50]


def test_deep_dive_by_id(spark):
    cols = ["transaction_id", "transaction_amt", "product_cd", "card4", "risk_score",
            "risk_assessment", "likely_pattern", "recommended_action", "confidence", "case_note"]
    base = spark.createDataFrame([(1, 2.0, "W", "visa", 75, "high", "p", "a", 0.5, "n"),
                                  (1, 2.0, "W", "visa", 75, "high", "p", "a", 0.5, "n"),
                                  (2, 3.0, "C", None, 0, None, None, None, None, None)], cols)
    assert deep_dive(base, 1).count() == 1
    ids = spark.createDataFrame([(2,)], "transaction_id long")
    assert deep_dive(base, ids).select(F.col("product_cd")).first()[0] == "C"


def test_broadcast_only_below_the_row_bound(spark):
    from riskmart.operators.joins import broadcast_if_small
    df = spark.range(3)

    def hinted(d):
        return "broadcast" in d._jdf.queryExecution().analyzed().toString().lower()
    assert hinted(broadcast_if_small(df, max_rows=3))
    assert not hinted(broadcast_if_small(df, max_rows=2))


def test_upsert_keeps_the_key_unique(spark):
    rows = [_note("7", "low", 0.1), ("7", "high", "p", 0.9, "r", "decline", "n", "{b}")]
    out = upsert_case_notes(empty_notes(spark), spark.createDataFrame(rows, SCHEMA)).collect()
    # Same created_at (one batch), so the larger answer text wins: "{}" > "{b}".
    assert len(out) == 1 and out[0]["raw_response"] == "{}"
    again = upsert_case_notes(empty_notes(spark), spark.createDataFrame(rows, SCHEMA)).collect()
    assert again[0]["risk_assessment"] == out[0]["risk_assessment"]      # deterministic


def test_one_pass_worksheets_equal_the_single_sheets(spark):
    import math

    from riskmart.operators import reporting as rp
    from riskmart.plans.queries import _base
    from tests.conftest import SF001
    base = _base(spark, SF001)
    got = {(r["worksheet"], r["value"]): r for r in rp.worksheet_measures(base).collect()}
    singles = {"fraud_rate_by_hour": (rp.fraud_rate_by_hour, "hour_of_day"),
               "fraud_rate_by_card_network": (rp.fraud_rate_by_card_network, "card4"),
               "fraud_rate_by_product": (rp.fraud_rate_by_product, "product_cd"),
               "fraud_rate_by_score_band": (rp.fraud_rate_by_score_band, "score_band")}
    n = 0
    for sheet, (fn, dim) in singles.items():
        for r in fn(base).collect():
            v = None if r[dim] is None else str(r[dim])
            assert got[(sheet, v)]["fraud_rate"] == r["fraud_rate"]
            n += 1
    k = rp.kpis(base).first()
    total = got[("kpi_overview", None)]
    assert total["fraud_count"] == k["fraud_count"]
    assert total["total_transactions"] == k["total_transactions"]
    assert math.isclose(total["amount_at_risk"], k["amount_at_risk"], rel_tol=1e-12)
    assert len(got) == n + 1
