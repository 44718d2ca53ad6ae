"""Every registered query of the analytics part against its DuckDB SQL on the
smallest tables (the operators for training data have tests of their own)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from trendflow.catalog import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def duck_tables():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def assert_matches_sql(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    cur = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted((tuple(_norm(dict(zip(names, r))[c]) for c in cols) for r in cur.fetchall()),
                  key=repr)
    assert len(got) == len(want)
    assert got == want


@pytest.fixture(scope="module")
def duck():
    return duck_tables()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    assert_matches_sql(spark, duck, name)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:4] == ["category_name", "category_id", "region", "trending_date_parsed"]
    assert df.count() > 0
