"""Every core query against its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from pagewright.plans import oracle, queries


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for f in Path(sf).glob("*.parquet"):
        c.sql(f"create view {f.stem} as select * from '{f}'")
    return c


def plain(v):
    return "" if v is None or isinstance(v, float) and math.isnan(v) else repr(v + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_same_rows(spark, duck, sf, name):
    df = queries.queries()[name](spark, sf)
    columns = sorted(df.columns)
    mine = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    rel = duck.sql(oracle.oracle_sql()[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert mine == sorted(tuple(plain(r[i]) for i in at) for r in rel.fetchall())


def test_all_have_sql():
    assert set(queries.queries()) == set(oracle.oracle_sql())
