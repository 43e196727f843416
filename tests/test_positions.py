"""Positions of sorted rows over many partitions."""

import random

from pyspark.sql import functions as F

from riskmart.operators.positions import with_position
from riskmart.sources.tables import LayerStore


def test_positions_over_partitions(spark, tmp_dir):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(40)]), i) for i in range(3000)]
    store = LayerStore(spark, tmp_dir)
    df = spark.createDataFrame(rows, "k int, id int").repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = with_position(df, [F.desc_nulls_last("k"), F.asc("id")], store, "p").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    expected = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r["k"], r["id"]) for r in sorted(got, key=lambda r: r["position"])] == expected
    assert sorted(r["position"] for r in got) == list(range(1, 3001))
    assert len(store.read("p").select("position__part").distinct().collect()) > 1


def test_positions_of_nothing(spark, tmp_dir):
    df = spark.createDataFrame([], "k int")
    assert with_position(df, [F.asc("k")], LayerStore(spark, tmp_dir), "p").count() == 0
