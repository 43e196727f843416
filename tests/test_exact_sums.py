"""Sums of doubles: the same bits for any order of rows, the nearest double to the true total."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from riskmart.functions.exact import exact_avg, exact_sum

bits = lambda x: None if x is None else struct.pack("<d", x)


def groups():
    rng = random.Random(5)
    cents = [round(rng.uniform(0.01, 900), 2) for _ in range(4000)]
    out = {
        "cents": cents,
        "signs": [rng.choice((-1, 1)) * c for c in cents],
        "wide": [rng.choice((-1, 1)) * rng.random() * 10 ** rng.randint(-9, 14) for _ in range(3000)],
        "cancel": [1e15, 0.1, -1e15, 1e-6, 2.5, -2.6],
        "tie": [2.0 ** 53 - 1, 0.5, 2.0 ** -40],
        "below": [1.0, 2.0 ** -53, 2.0 ** -90],
        "negative tie": [-1.0, -(2.0 ** -53), -(2.0 ** -90)],
        "zero": [0.0, -0.0],
        "tiny": [2.0 ** -60] * 3,
        "one": [42.385],
        "third": [0.1] * 10,
    }
    for k in range(40):
        out[f"random {k}"] = [rng.gauss(0, 10.0 ** rng.randint(-3, 9)) for _ in range(rng.randint(1, 9))]
    return out


@pytest.fixture(scope="module")
def rows():
    found = [(g, x) for g, xs in groups().items() for x in xs] + [("empty", None), ("cents", None)]
    random.Random(1).shuffle(found)
    return found


def test_nearest_double_in_any_partitioning(spark, rows):
    df = spark.createDataFrame(rows, "g string, x double")
    seen = []
    for parts in (1, 7, 200):
        got = df.repartition(parts).groupBy("g").agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).collect()
        seen.append({r["g"]: (bits(r["s"]), bits(r["a"])) for r in got})
    assert seen[0] == seen[1] == seen[2]
    for g, xs in groups().items():
        total = math.fsum(xs) + 0.0
        assert seen[0][g] == (bits(total), bits(total / len(xs))), g
    assert seen[0]["empty"] == (None, None)


def test_values_beyond_the_limbs(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([("n", 1.0), ("n", nan), ("i", 1.5), ("i", inf), ("m", inf), ("m", -inf), ("h", 1e300),
                                ("h", 2.0)], "g string, x double")
    got = {r["g"]: r["s"] for r in df.groupBy("g").agg(exact_sum("x").alias("s")).collect()}
    assert math.isnan(got["n"]) and got["i"] == inf and math.isnan(got["m"]) and got["h"] == 1e300


def test_plain_aggregate_forms(spark, rows):
    df = spark.createDataFrame(rows, "g string, x double")
    assert df.where("g = 'third'").agg(exact_sum("x")).first()[0] == 1.0
    assert df.limit(0).agg(exact_sum("x"), exact_avg("x")).first() == (None, None)
    positive = df.where("g = 'signs'").agg(exact_sum(F.when(F.col("x") > 0, F.col("x")))).first()[0]
    assert positive == math.fsum(x for x in groups()["signs"] if x > 0)
