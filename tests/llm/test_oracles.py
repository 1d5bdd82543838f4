"""The text queries that SQL can express, against DuckDB on the same tables."""

from __future__ import annotations

import os
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

from ledgerloom.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, SF)
    con.execute(ORACLES[name])
    columns = [d[0] for d in con.description]
    order = sorted(columns)
    theirs = sorted((tuple(r[columns.index(c)] for c in order) for r in con.fetchall()), key=repr)
    assert sorted(df.columns) == order
    assert sorted(map(tuple, df.select(*order).collect()), key=repr) == theirs
