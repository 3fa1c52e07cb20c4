"""Every query against its SQL text in DuckDB, over the whole given tables."""

from __future__ import annotations

import math

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _value(value):
    if value is None or value is pd.NA or value is pd.NaT:
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return str(value) if isinstance(value, pd.Timestamp) else value


def _rows(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    plain = (tuple(_value(v) for v in row) for row in frame[columns].itertuples(index=False))
    return sorted(plain, key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    if name not in SQL:
        assert len(got.columns) > 0
        return
    want = duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_names_are_paired():
    assert set(SQL) <= set(QUERIES)
