"""Every registered query against its SQL, run by DuckDB on the same tables."""

from __future__ import annotations

import math
import sys
from collections import Counter
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from checks.oracles import ORACLES  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from conftest import SF_DIR  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value) if value is not None else None


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(canonical(row[i]) for i in order) for row in rows)


SPARK_TO_DUCK = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    ours = multiset(df.columns, [tuple(r) for r in df.collect()])
    duck.execute(ORACLES[name])
    columns = [d[0] for d in duck.description]
    types = {d[0]: str(d[1]) for d in duck.description}
    theirs = multiset(columns, duck.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert {c: SPARK_TO_DUCK[t] for c, t in df.dtypes} == types
    assert sum(ours.values()) == sum(theirs.values())
    missing, extra = theirs - ours, ours - theirs
    assert not missing and not extra, (list(missing)[:3], list(extra)[:3])
    assert sum(ours.values()) > 0


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLES)
