"""Every query with SQL beside it gives the same rows as DuckDB."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

from ledgerloom import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
catalog.load()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    show = lambda v: "" if pd.isna(v) else repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(show(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_rows(spark, duck, name):
    ours, theirs = catalog.QUERIES[name](spark, DATA).toPandas(), duck.sql(catalog.SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() > 0
