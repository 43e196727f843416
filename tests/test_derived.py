"""Boundaries of the derived features and numeric helpers."""

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskmart.functions.derived import (
    amount_bucket, day_of_week, hour_of_day, percent, round_half_away, score_band,
)


def _one(spark, rows, schema, *exprs):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*exprs).collect()]


def test_hour_rounds_half_to_even(spark):
    secs = [0, 1799, 1800, 1801, 5400, 9000, 84599, 84600, 86399, 86400, None]
    got = _one(spark, [(s,) for s in secs], "dt bigint", hour_of_day("dt"))
    assert [g[0] for g in got] == [0, 0, 0, 1, 2, 2, 23, 24, 24, 0, None]


def test_hour_floor_mode_gives_clock_hours(spark):
    got = _one(spark, [(84600,), (86399,)], "dt bigint", hour_of_day("dt", "floor"))
    assert [g[0] for g in got] == [23, 23]


def test_day_of_week_reaches_seven(spark):
    got = _one(spark, [(604799,), (43199,), (43200,), (129600,)], "dt bigint", day_of_week("dt"))
    assert [g[0] for g in got] == [7, 0, 0, 2]


def test_hour_and_day_agree_with_sql_cast(spark):
    con = duckdb.connect()
    secs = list(range(0, 604800, 1799)) + [1800, 5400, 604799]
    expect = con.execute(
        "SELECT CAST((s % 86400) / 3600 AS INTEGER), CAST((s % 604800) / 86400 AS INTEGER) "
        "FROM unnest(?::BIGINT[]) t(s)", [secs]).fetchall()
    got = _one(spark, [(s,) for s in secs], "dt bigint", hour_of_day("dt"), day_of_week("dt"))
    assert got == [tuple(e) for e in expect]


@pytest.mark.parametrize("amt,band", [
    (9.99, "under_10"), (10.0, "10_to_50"), (49.99, "10_to_50"), (50.0, "50_to_200"),
    (199.99, "50_to_200"), (200.0, "200_to_500"), (499.99, "200_to_500"), (500.0, "over_500"),
    (None, "over_500"), (-1.0, "under_10"),
])
def test_amount_bucket_edges(spark, amt, band):
    assert _one(spark, [(amt,)], "a double", amount_bucket("a"))[0][0] == band


@pytest.mark.parametrize("score,band", [
    (100, "Critical (75)"), (75, "Critical (75)"), (74, "High (50)"), (50, "High (50)"),
    (25, "Medium (25)"), (0, "Low (0)"), (None, "Low (0)"),
])
def test_score_band(spark, score, band):
    assert _one(spark, [(score,)], "s int", score_band("s"))[0][0] == band


def test_percent_of_zero_is_null(spark):
    assert _one(spark, [(1, 0)], "a bigint, b bigint", percent("a", "b"))[0][0] is None


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1,
                max_size=40), st.integers(min_value=0, max_value=4))
def test_round_matches_sql_round(spark, xs, digits):
    xs = xs + [1.005, 2.675, 0.125, -2.5, 12.345]
    con = duckdb.connect()
    expect = [r[0] for r in con.execute(
        f"SELECT ROUND(x, {digits}) FROM unnest(?::DOUBLE[]) WITH ORDINALITY t(x, i) ORDER BY i",
        [xs]).fetchall()]
    got = [r[0] for r in _one(spark, [(x,) for x in xs], "x double",
                              round_half_away("x", digits))]
    assert got == expect
