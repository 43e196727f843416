"""The raw load accounts for every record, and types what no layout lists."""

import os

import pytest

from riskmart.operators.column_types import merged, narrowest, type_counts
from riskmart.plans.load import LoadRejected, load_csv
from riskmart.plans.pipeline import RAW_FILES
from riskmart.sources.csv import export_csv, import_csv
from riskmart.sources.tables import LayerStore

HEAD = "TransactionID,isFraud,TransactionDT,TransactionAmt,ProductCD,Extra-Num,Extra-Odd"
GOOD = ["1,0,5,9.5,W,1,2024-01-01", "2.0,1,6,8,W,2.5,2024-01-02 03:04:05", "9007199254740993,0,7,1e2,W,,",
        "9007199254740993.0,,8,\"1.5\",\"a,b\",3,"]
BAD = {"1,0,5,9.5,W,1,2024-01-01,EXTRA,FIELDS": "more or fewer fields than the header",
       "3,0,5": "more or fewer fields than the header",
       "12.5,0,5,9.5,W,1,": "transaction_id holds 12.5",
       "99999999999999999999,0,5,9.5,W,1,": "transaction_id holds 99999999999999999999",
       "5,maybe,noon,ten,W,1,": "is_fraud holds maybe; transaction_id",
       "6,0,5.5,9.5,W,1,": "transaction_dt holds 5.5"}


def raw(folder, train, test=("7,5,9.5,W,4,",)):
    files = {"train_transaction": [HEAD, *train], "test_transaction": [HEAD.replace("isFraud,", ""), *test],
             "train_identity": ["TransactionID,id_01,Extra", "1,-5,true"], "test_identity": ["TransactionID,id-01,Extra", "7,,"]}
    for key, lines in files.items():
        with open(os.path.join(folder, RAW_FILES[key]), "w") as f:
            f.write("\n".join(lines) + "\n")
    return folder


def test_every_record_is_accounted_for(spark, tmp_dir):
    os.makedirs(tmp_dir + "/raw")
    store = LayerStore(spark, tmp_dir + "/layers")
    load_csv(spark, store, raw(tmp_dir + "/raw", GOOD + list(BAD)), max_rejects=len(BAD))
    report = {(r["table_name"], r["split"]): tuple(r)[2:] for r in store.read("load_report").collect()}
    assert report == {("stg_transactions", "train"): (10, 4, 6), ("stg_transactions", "test"): (1, 1, 0),
                      ("stg_identity", "train"): (1, 1, 0), ("stg_identity", "test"): (1, 1, 0)}
    rejects = store.read("load_rejects").collect()
    assert all(r["file"].endswith(RAW_FILES["train_transaction"]) and r["split"] == "train" for r in rejects)
    found = {r["record"]: r["reason"] for r in rejects}
    assert {k for k in BAD if k.count(",") != 6} <= set(found)
    for record, reason in BAD.items():
        hits = [r for r in found.values() if reason.split(" holds ")[0].split(";")[0] in r and reason.split("; ")[0] in r]
        assert hits, record
    rows = store.read("stg_transactions")
    assert sorted(r[0] for r in rows.where("split = 'train'").select("transaction_id").collect()) == [
        1, 2, 9007199254740993, 9007199254740993]
    assert dict(rows.dtypes)["extra_num"] == "double" and dict(rows.dtypes)["extra_odd"] == "timestamp_ntz"
    assert dict(store.read("stg_identity").dtypes)["extra"] == "boolean"


@pytest.mark.parametrize("record,reason", BAD.items())
def test_a_reject_fails_the_load(spark, tmp_dir, record, reason):
    os.makedirs(tmp_dir + "/raw")
    with pytest.raises(LoadRejected, match=reason.split("; ")[0].split(" holds ")[0]):
        load_csv(spark, LayerStore(spark, tmp_dir + "/layers"), raw(tmp_dir + "/raw", [GOOD[0], record]))


def test_a_clean_load_has_empty_rejects(spark, tmp_dir):
    os.makedirs(tmp_dir + "/raw")
    store = LayerStore(spark, tmp_dir + "/layers")
    load_csv(spark, store, raw(tmp_dir + "/raw", GOOD))
    assert store.read("load_rejects").count() == 0


@pytest.mark.parametrize("values,kind", [
    ([], "string"), ([None, ""], "string"), (["1", "-2", ""], "bigint"), (["1", "2.5"], "double"), (["1e5", ".5", "7."], "double"),
    (["true", "False"], "boolean"), (["true", "1"], "string"), (["2024-01-01"], "date"),
    (["2024-01-01", "2024-01-01 10:00:00.5"], "timestamp_ntz"), (["2024-13-01"], "string"), (["1", "2024-01-01"], "string"),
    (["99999999999999999999"], "double"), (["1d"], "string"), (["nan"], "string"), ([" 1"], "string")])
def test_narrowest_type(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], "`a``b` string")
    found = type_counts(df, ["a`b"])
    assert narrowest(found["a`b"]) == kind
    halves = [type_counts(df.limit(0), ["a`b"]), found]
    assert narrowest(merged(*halves)["a`b"]) == kind


def test_exports_keep_every_text(spark, tmp_dir):
    texts = ["\\N", "\\", "\\\\", "\\n", "\\\n", "\n\\n\r\\r\n", "\\\\N", "a\\", "\r\n", " ", "", None, '"', '\\"', "a,b\n\"c\"", "ß x"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, `odd name` string")
    export_csv(df, tmp_dir + "/x")
    assert sorted(map(tuple, import_csv(spark, tmp_dir + "/x", df.schema).collect())) == list(enumerate(texts))
    lines = [line for f in os.listdir(tmp_dir + "/x") if f.endswith(".csv") for line in open(f"{tmp_dir}/x/{f}", newline="")]
    assert sum(not line.startswith('"id"') for line in lines) == len(texts)          # a record a line
