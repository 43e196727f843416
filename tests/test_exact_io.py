"""Nothing is lost on the way in or out: CSV text and times, labels, bad values, changed inputs."""

import datetime as dt
import os
import shutil

import pyarrow.parquet as pq
import pytest

from riskmart.operators.staging import stage_transactions
from riskmart.plans.catalog import layers_for
from riskmart.sources.csv import export_csv, import_csv
from tests.conftest import SF0001


def test_csv_round_trip_is_exact(spark, tmp_dir):
    schema = "id long, text string, at timestamp"
    at = dt.datetime(2024, 1, 2, 3, 4, 3, 456789)
    texts = ["  lead", "trail  ", " \n{a}\n ", "", None, 'q"u"o', "a,b", "\\N x", "cr\rlf\n", "\t"]
    df = spark.createDataFrame([(i, t, at if i % 2 else None) for i, t in enumerate(texts)], schema)
    path = os.path.join(tmp_dir, "csv")
    export_csv(df, path)
    assert sorted(map(tuple, import_csv(spark, path, schema).collect())) == sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("text,value", [("1", True), ("0", False), ("1.0", True), ("0.0", False), ("true", True),
                                        ("True", True), ("false", False), ("", None), (None, None)])
def test_label_forms(spark, text, value):
    raw = spark.createDataFrame([("7", text)], "TransactionID string, isFraud string")
    assert stage_transactions(raw).first()["is_fraud"] is value


@pytest.mark.parametrize("column,text", [("TransactionID", "x5"), ("isFraud", "maybe"), ("TransactionDT", "noon"),
                                         ("TransactionAmt", "ten")])
def test_bad_strict_values_fail(spark, column, text):
    row = {"TransactionID": "1", "isFraud": "0", "TransactionDT": "5", "TransactionAmt": "1.5"} | {column: text}
    raw = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in row))
    with pytest.raises(Exception, match=text):
        stage_transactions(raw).collect()


def test_changed_input_gets_new_layers(spark, tmp_dir):
    source = os.path.join(tmp_dir, "sf")
    shutil.copytree(SF0001, source)
    events = os.path.join(source, "events.parquet")
    first = layers_for(spark, source)
    assert layers_for(spark, source) is first
    part = pq.read_table(os.path.join(SF0001, "events.parquet")).slice(0, 50)
    os.chmod(events, 0o644)
    pq.write_table(part, events)
    assert layers_for(spark, source) is not first
