"""Golden rows of the column functions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import ledger, parse, rules
from ledgerloom.schemas import OCCUPATION_PLACEHOLDERS, PAYMENT_BEHAVIOUR_PATTERN, SSN_PATTERN


def apply(spark, values, kind, fn):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.select("i", fn(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strip_parse_int(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        given = {
            "23_": 23,
            "-500": -500,
            "": None,
            None: None,
            "1.5": 1,
            "-1.9": -1,
            "__10__": 10,
            "1e12": None,
            "4e1": None,
            "4d": None,
            " 7 ": 7,
            "+3": 3,
            "99999999999": None,
            "2147483647": 2147483647,
            "NaN": None,
            "abc": None,
        }
        assert apply(spark, list(given), "string", parse.strip_parse_int) == list(given.values())
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_parse_int_does_not_strip(spark):
    assert apply(spark, ["5", "5_"], "string", parse.parse_int) == [5, None]


def test_strip_parse_double(spark):
    texts = ["1_000.5", "_", "x", None, "1e3", "4d", "0x1p3", "1e400", " -.5 "]
    expected = [1000.5, None, None, None, 1000.0, None, None, None, -0.5]
    assert apply(spark, texts, "string", parse.strip_parse_double) == expected


def test_parse_int_of_any_size(spark):
    texts = ["1.9999999", "-0.7", ".5", "+", "9223372036854775807.9", "9223372036854775808"]
    got = apply(spark, texts, "string", lambda c: parse.parse_int(c, "bigint"))
    assert got == [1, 0, 0, None, 2**63 - 1, None]


def test_ledger_of_tiny_instalments(spark):
    """No amount stops the job, and too many missed instalments are not none."""
    rows = [(0.001, 1e6), (0.001, 5e6), (1e-320, 1.0), (0.0, 5.0), (None, 5.0), (5.0, None), (10.0, 25.0), (1.0, -9e18)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, due double, overdue double")
    missed = ledger.installments_missed(F.col("overdue"), F.col("due"))
    df = df.withColumn("s", F.lit(dt.date(2024, 3, 31))).withColumn("missed", missed)
    df = df.withColumn("first", ledger.first_missed_date(F.col("s"), F.col("missed")))
    dpd = ledger.days_past_due(F.col("s"), F.col("overdue"), F.col("first"))
    df = df.withColumn("label", ledger.default_label(dpd, 30))
    got = [(r.missed, r["first"], r.label) for r in df.orderBy("i").collect()]
    floor, most = ledger.FIRST_DATE, ledger.MOST_MISSED
    assert got == [
        (10**9, floor, 1), (most, floor, 1), (most, floor, 1), (0, None, 0), (0, None, 0), (0, None, 0),
        (3, dt.date(2023, 12, 31), 1), (-most, None, 0),
    ]


def test_null_out_of_range(spark):
    kept = apply(spark, [-1, 0, 120, 121, None], "int", lambda c: rules.null_out_of_range(c, 0, 120))
    assert kept == [None, 0, 120, None, None]


def test_valid_or(spark):
    got = apply(
        spark, ["123-45-6789", "#F%$", None], "string", lambda c: rules.valid_or(c, SSN_PATTERN)
    )
    assert got == ["123-45-6789", "Unknown", "Unknown"]
    got = apply(
        spark,
        ["High_spent_Small_value_payments", "!@9#%8", "a_b_c_d", None],
        "string",
        lambda c: rules.valid_or(c, PAYMENT_BEHAVIOUR_PATTERN),
    )
    assert got == ["High_spent_Small_value_payments", "Unknown", "Unknown", "Unknown"]


def test_placeholder_to(spark):
    got = apply(
        spark,
        ["_______", " ", "Doctor", None],
        "string",
        lambda c: rules.placeholder_to(c, OCCUPATION_PLACEHOLDERS, trim=True),
    )
    assert got == ["Unknown", "Unknown", "Doctor", None]
    got = apply(spark, ["_", " _", None], "string", lambda c: rules.placeholder_to(c, ["_"]))
    assert got == ["Unknown", " _", None]


def test_duration_months(spark):
    given = {
        "22 Years and 1 Months": 265,
        "1 Year and 1 Month": 13,
        "5 Years": None,
        "7 Months": None,
        "": None,
        None: None,
    }
    assert apply(spark, list(given), "string", rules.duration_months) == list(given.values())


def test_membership_flag(spark):
    text = ["Auto Loan, and Home Equity Loan", "auto loan", None]
    assert apply(spark, text, "string", lambda c: rules.membership_flag(c, "Auto Loan")) == [
        "Yes",
        "No",
        "No",
    ]


def test_first_missed_date_clamps_to_month_end(spark):
    got = apply(
        spark,
        [dt.date(2023, 3, 31), dt.date(2023, 3, 1)],
        "date",
        lambda c: ledger.first_missed_date(c, F.lit(1)),
    )
    assert got == [dt.date(2023, 2, 28), dt.date(2023, 2, 1)]


def test_rule_options(spark):
    rows = [("Auto Loan, and Home Equity Loan", "5 Years"), ("Not Auto Loan", "3 Months"), ("Auto Loan", "2 Years and 1 Month"), (None, "soon"), ("", None)]
    df = spark.createDataFrame(rows, "loans string, age string").select(
        rules.membership_flag(F.col("loans"), "Auto Loan").alias("part"),
        rules.membership_flag(F.col("loans"), "Auto Loan", exact=True).alias("entry"),
        rules.membership_flag(F.col("loans"), "Home Equity Loan", exact=True).alias("last"),
        rules.duration_months(F.col("age")).alias("both"),
        rules.duration_months(F.col("age"), missing_as_zero=True).alias("any"),
        rules.placeholder_to(F.col("loans"), [""], "?", null_too=True).alias("filled"),
    )
    assert [tuple(r) for r in df.collect()] == [
        ("Yes", "Yes", "Yes", None, 60, rows[0][0]),
        ("Yes", "No", "No", None, 3, "Not Auto Loan"),
        ("Yes", "Yes", "No", 25, 25, "Auto Loan"),
        ("No", "No", "No", None, None, "?"),
        ("No", "No", "No", None, None, "?"),
    ]
