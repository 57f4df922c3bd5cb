"""Every query of the core package against its SQL on the smallest test tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from tidemill.plans import catalogue

DATA = Path("/root/testdata/sf0.001")
QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    names = sorted(df.columns)
    rows = Counter(tuple(plain(v) for v in r) for r in df.select(*names).collect())
    if name not in SQL:
        return
    cur = duck.execute(SQL[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == names
    at = [cols.index(n) for n in names]
    assert Counter(tuple(plain(r[i]) for i in at) for r in cur.fetchall()) == rows


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
