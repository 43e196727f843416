"""Every registered query against its DuckDB SQL on the sf0.01 driver tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from riskmart.plans.queries import REGISTRY
from tests.conftest import SF001

TABLES = ["events", "documents", "embeddings"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _key(row):
    return tuple((0, "") if v is None else (1, round(v, 6) if isinstance(v, float) else str(v))
                 for v in row)


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)
    return a == b


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF001)
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    order = sorted(df.columns)
    srows = sorted((tuple(r[c] for c in order) for r in df.collect()), key=_key)
    drows = sorted((tuple(r[dcols.index(c)] for c in order) for r in res.fetchall()), key=_key)
    assert len(srows) == len(drows)
    for a, b in zip(srows, drows):
        assert all(_same(x, y) for x, y in zip(a, b)), (a, b)


def test_every_query_has_oracle():
    assert set(REGISTRY) <= set(entry.queries()) & set(entry.oracle_sql())
