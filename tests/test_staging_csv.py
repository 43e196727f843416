"""Raw CSV staging: header-driven select, tolerant casts, NULL text, unknown columns,
identity name normalization, and the layer build on top of it."""

import os

import pytest

from riskmart.plans.pipeline import RAW_FILES, build_layers, staged_from_csv
from riskmart.sources.csv import read_header
from riskmart.sources.tables import LayerStore

TRAIN_TXN = """TransactionID,isFraud,TransactionDT,TransactionAmt,ProductCD,card1,card2,card3,card4,card5,card6,addr1,addr2,dist1,dist2,P_emaildomain,R_emaildomain,C1,C2,D1,M1,V1,Extra_Col
1,0,86400,68.5,W,13926,404.0,150.0,visa,142.0,credit,315.0,87.0,19.0,,Gmail.COM,"",1.0,1.0,14.0,T,1.0,foo
2,1,90000,29.0,H,2755,abc,150.0,mastercard,102.0,debit,,87.0,,,"",yahoo.com,4.0,1.0,0.0,,,bar
3,0,1800,600.25,C,4663,490.0,150.0,"american express",166.0,credit,330.0,87.0,287.0,,"Mail.com",,2.0,5.0,,F,1.0,"with, comma"
"""
TEST_TXN = """TransactionID,TransactionDT,TransactionAmt,ProductCD,card1,card2,card3,card4,card5,card6,addr1,addr2,dist1,dist2,P_emaildomain,R_emaildomain,C1,C2,D1,M1,V1,Extra_Col
10,1814500,12.0,W,13926,404.0,150.0,visa,142.0,credit,315.0,87.0,,,gmail.com,,5.0,1.0,,T,,baz
9007199254740993,1814501,1.0,W,9007199254740993,404.5,150.0,visa,142.0,credit,,,,,gmail.com,,5.0,1.0,,T,,
"""
TRAIN_ID = """TransactionID,id_01,id_02,id_12,id_13,id_15,id_30,id_31,DeviceType,DeviceInfo
1,0.0,70787.0,NotFound,,New,Android 7.0,samsung browser 6.2,mobile,SAMSUNG SM-G892A
99,-5.0,98945.0,NotFound,49.0,Found,,chrome 62.0,desktop,
"""
TEST_ID = """TransactionID,id-01,id-02,id-12,id-13,id-15,id-30,id-31,DeviceType,DeviceInfo
10,-45.0,280290.0,NotFound,27.0,New,,chrome 67.0 for android,mobile,MYA-L13
"""


@pytest.fixture(scope="module")
def raw_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("raw")
    for key, text in (("train_transaction", TRAIN_TXN), ("test_transaction", TEST_TXN),
                      ("train_identity", TRAIN_ID), ("test_identity", TEST_ID)):
        (d / RAW_FILES[key]).write_text(text)
    return str(d)


@pytest.fixture(scope="module")
def staged(spark, raw_dir):
    return staged_from_csv(spark, raw_dir)


def test_header_discovery(spark, raw_dir):
    assert read_header(spark, os.path.join(raw_dir, RAW_FILES["test_identity"]))[:3] == \
        ["TransactionID", "id-01", "id-02"]


def test_transaction_staging(staged):
    txn, _ = staged
    rows = {r["transaction_id"]: r for r in txn.collect()}
    assert set(rows) == {1, 2, 3, 10, 9007199254740993}          # 2**53 + 1 kept exactly
    assert rows[9007199254740993]["card1"] == 9007199254740993
    assert rows[9007199254740993]["card2"] == 404                # 404.5 rounds half to even
    assert rows[1]["split"] == "train" and rows[1]["is_fraud"] is False
    assert rows[2]["is_fraud"] is True
    assert rows[10]["split"] == "test" and rows[10]["is_fraud"] is None
    assert rows[1]["card2"] == 404 and rows[2]["card2"] is None        # 'abc' -> NULL
    assert rows[1]["p_emaildomain"] == "gmail.com"                      # lower-cased
    assert rows[3]["p_emaildomain"] == "mail.com"
    assert rows[2]["p_emaildomain"] is None                             # quoted empty
    assert rows[1]["r_emaildomain"] is None
    assert rows[2]["addr1"] is None and rows[1]["dist2"] is None
    assert rows[1]["extra_col"] == "foo" and rows[3]["extra_col"] == "with, comma"
    assert rows[1]["c2"] == 1.0 and rows[1]["d1"] == 14.0 and rows[1]["m1"] == "T"
    assert rows[1]["c14"] is None                                       # absent column
    types = dict(txn.dtypes)
    assert types["card2"] == "int" and types["transaction_id"] == "bigint"
    assert types["is_fraud"] == "boolean" and types["v339"] == "double"


def test_identity_staging(staged):
    _, ident = staged
    rows = {r["transaction_id"]: r for r in ident.collect()}
    assert set(rows) == {1, 99, 10}
    assert rows[10]["id_01"] == -45.0 and rows[10]["split"] == "test"  # id-01 -> id_01
    assert rows[99]["device_info"] is None and rows[99]["id_13"] == 49.0
    assert dict(ident.dtypes)["id_12"] == "string"


def test_layers_from_csv(spark, staged, tmp_dir):
    txn, ident = staged
    layers = build_layers(LayerStore(spark, tmp_dir), txn, ident, min_rows=1)
    e = {r["transaction_id"]: r for r in layers.enriched.collect()}
    assert len(e) == 5                                  # left join keeps every transaction
    assert e[2]["device_type"] is None                  # transaction without identity
    assert e[1]["device_info"] == "SAMSUNG SM-G892A"
    assert e[3]["amount_bucket"] == "over_500" and e[3]["hour_of_day"] == 0
    assert layers.fact.count() == 3
    s = {r["transaction_id"]: r for r in layers.scoring.collect()}
    assert s[2]["velocity_flag"] == 1 and s[1]["velocity_flag"] == 0
    # The NULL-domain group has a 100 % rate, but a NULL domain never matches.
    assert s[2]["email_risk_flag"] == 0


def test_dashboard_export_round_trip(spark, staged, tmp_dir):
    from riskmart.operators.casenotes import empty_notes, upsert_case_notes
    from riskmart.plans.pipeline import dashboard_schemas, export_dashboard, read_dashboard
    txn, ident = staged
    layers = build_layers(LayerStore(spark, tmp_dir + "/l"), txn, ident, min_rows=1)
    incoming = spark.createDataFrame(
        [("1", "high", "card_testing", 0.8, 'Line one,\n"quoted" line two', "decline",
          "note {x}", '```json\n{"a": "b, c"}\n```')],
        "transaction_id string, risk_assessment string, likely_pattern string, "
        "confidence double, reasoning string, recommended_action string, case_note string, "
        "raw_response string")
    notes = upsert_case_notes(empty_notes(spark), incoming)
    paths = export_dashboard(layers, notes, tmp_dir + "/exports")
    back = read_dashboard(spark, paths, dashboard_schemas(layers))
    assert sorted(map(tuple, back["case_notes"].drop("created_at").collect())) == \
        sorted(map(tuple, notes.drop("created_at").collect()))
    assert back["case_notes"].where("created_at IS NULL").count() == 0
    assert sorted(map(tuple, back["rule_based_scoring"].collect())) == \
        sorted(map(tuple, layers.scoring.collect()))
    assert back["fct_fraud_analysis"].count() == 3
