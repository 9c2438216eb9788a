"""Every registered query against its SQL twin."""

import math
import os

import duckdb
import pandas as pd
import pytest

from conftest import DATA
from urlsheaf.plans.catalogue import ORACLE, QUERIES

TABLES = [f[:-8] for f in sorted(os.listdir(DATA)) if f.endswith(".parquet")]


@pytest.fixture(scope="module")
def twin():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def plain(value):
    if pd.isna(value):
        return None
    return value.item() if hasattr(value, "item") else value


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    made = [tuple(plain(v) for v in r) for r in frame.itertuples(index=False, name=None)]
    return sorted(made, key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, twin, name):
    got = QUERIES[name](spark, DATA).toPandas()
    if name not in ORACLE:
        assert len(got) > 0
        return
    want = twin.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    left, right = rows(got), rows(want)
    assert len(left) == len(right)
    for a, b in zip(left, right):
        for x, y in zip(a, b):
            assert x == y or (isinstance(x, float) and math.isclose(x, y, rel_tol=1e-12))


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() == 1
    assert set(oracle_sql()) <= set(queries())
