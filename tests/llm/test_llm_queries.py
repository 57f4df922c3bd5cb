"""Every query of the subpackage on the smallest test tables: columns, no repeated rows, and its SQL where there is one."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from tidemill.llm.queries import QUERIES, SQL

DATA = Path("/root/testdata/sf0.001")
COLUMNS = {
    "p2_found": ["sha_a", "sha_b"], "p3_found": ["group_id", "sha256"], "p4_found": ["staged_id"], "p5_found": ["key_a", "key_b"], "p7_found": ["row_a", "row_b"],
    "p8_ids": ["doc_id", "ids"], "p9_found": ["doc_id", "item_id"], "p10_found": ["doc_a", "doc_b"],
}
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not there")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, str(DATA))
    names = sorted(df.columns)
    if name in COLUMNS:
        assert names == COLUMNS[name]
    rows = Counter(tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in df.select(*names).collect())
    assert name == "p8_decoded" or max(rows.values(), default=1) == 1
    if name in SQL:
        con = duckdb.connect()
        for p in DATA.glob("*.parquet"):
            con.execute(f"create view {p.stem} as select * from '{p}'")
        cur = con.execute(SQL[name])
        at = [[c[0] for c in cur.description].index(n) for n in names]
        assert Counter(tuple(r[i] for i in at) for r in cur.fetchall()) == rows
