"""Methods that Java compiles, and what the shorter parsing still reads."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions import parse
from ledgerloom.operators.conform import enforce_schema, typed_together
from ledgerloom.operators.profile import profile_rows
from ledgerloom.plans import silver

COMPILED = 8000  # bytes of a method, above which HotSpot only interprets it


def largest_method(spark, df, capsys) -> int:
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        capsys.readouterr()
        df.select("*").explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)))


def texts(spark, types, folder):
    """A stored row of texts and a date, as bronze has them."""
    columns = [F.lit("5").alias(c) for c in types if c != "snapshot_date"]
    path = str(folder / "rows")
    spark.range(1).select(*columns, F.lit("2023-01-01").cast("date").alias("snapshot_date")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("table", ["clickstream", "financials", "loan_daily"])
def test_cleaning_is_compiled(spark, scratch, capsys, tmp_path, table):
    types = {"clickstream": schemas.CLICKSTREAM, "financials": schemas.FINANCIALS, "loan_daily": schemas.LOAN_DAILY}
    rows = texts(spark, types[table], tmp_path)
    clean = silver.clean_financials(rows, scratch=scratch) if table == "financials" else enforce_schema(rows, types[table])
    assert clean.columns == rows.columns
    assert largest_method(spark, clean, capsys) < COMPILED


def test_profiles_are_compiled(spark, capsys, tmp_path):
    clicks = enforce_schema(texts(spark, schemas.CLICKSTREAM, tmp_path), schemas.CLICKSTREAM)
    found = profile_rows(clicks, [schemas.CUSTOMER, schemas.SNAPSHOT], schemas.CLICK_COUNTERS)
    assert largest_method(spark, found, capsys) < COMPILED


INTS = {
    "5": 5, " 5\t": 5, "+5": 5, "-07": -7, "1.5": 1, "1.": 1, "-0.9": 0, ".5": 0, "+.5": 0, "-.25 ": 0, "\n8\n": 8,
    "2147483647.9": 2147483647, "2147483648": None, "2147483648.5": None, "": None, " ": None, "+": None, ".": None,
    "4e1": None, "5L": None, "0x1F": None, "1 2": None, "--5": None, "5\x01": None, "\x015": None, "5\u0085": None,
    ".5\u0085": None, "5.5 ": None, "٣": None, "1.5.5": None, "- 5": None, "NaN": None, None: None,
}
DOUBLES = {
    "5": 5.0, " -.5 ": -0.5, "1.": 1.0, "1e3": 1000.0, "1E-2": 0.01, "1e999": None, "-1e999": None, "5d": None,
    "5f": None, "0x1p3": None, "NaN": None, "Infinity": None, "": None, ".": None, "e5": None, None: None,
}


def test_odd_numbers_alone_and_together(spark):
    """The same, whether a column is read alone or with others."""
    for values, to, parser in ((INTS, "int", parse.parse_int), (DOUBLES, "double", parse.parse_double)):
        rows = spark.createDataFrame([(t, t, t and f"_{t}_") for t in values], "text string, a string, b string")
        alone = rows.select("text", parser(F.col("text")).alias("x")).collect()
        assert {r.text: r.x for r in alone} == values
        got = typed_together(rows, {"a": to, "b": to}, strip="_")
        assert got.columns == rows.columns and dict(got.dtypes)["a"] == to
        assert {r.text: (r.a, r.b) for r in got.collect()} == {t: (x, x) for t, x in values.items()}
