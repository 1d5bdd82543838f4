"""Operators on hand-made rows, and their invariants."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import conform, encode, impute, joins, labels, scale
from ledgerloom.operators.quantiles import group_quantiles
from ledgerloom.schemas import LOAN_DAILY
from ledgerloom.sources.scratch import Scratch

JAN, FEB = dt.date(2023, 1, 1), dt.date(2023, 2, 1)


def dated(spark, rows, columns):
    return spark.createDataFrame(rows, f"snapshot_date date, {columns}")


def test_fill_median_is_per_snapshot_and_lower_middle(spark, scratch):
    df = dated(
        spark,
        [(JAN, 10), (JAN, None), (JAN, 20), (JAN, 40), (FEB, 10), (FEB, 20), (FEB, None)],
        "x int",
    )
    for options in ({"scratch": scratch}, {"accuracy": 1000}):
        got = sorted((r[0], r[1]) for r in impute.fill_median(df, ["x"], **options).collect())
        assert got == [(JAN, 10), (JAN, 20), (JAN, 20), (JAN, 40), (FEB, 10), (FEB, 10), (FEB, 20)]


def test_fill_median_of_nothing_stays_null(spark, scratch):
    df = dated(spark, [(JAN, None), (JAN, None), (FEB, 3)], "x int")
    got = sorted((r[0], r[1] is None) for r in impute.fill_median(df, ["x"], scratch=scratch).collect())
    assert got == [(JAN, True), (JAN, True), (FEB, False)]


def test_replace_above_quantile(spark, scratch):
    df = dated(spark, [(JAN, x) for x in [*range(1, 200), 1000]], "x int")
    got = sorted(r[1] for r in impute.replace_above_quantile(df, {"x": "x"}, scratch=scratch).collect())
    assert got == sorted([*range(1, 199), 100, 100])


def test_replacement_may_come_from_another_column(spark, scratch):
    df = dated(spark, [(JAN, x, 7.0) for x in [*range(1, 200), 1000]], "x int, y double")
    got = [r["x"] for r in impute.replace_above_quantile(df, {"x": "y"}, scratch=scratch).collect()]
    assert got.count(7) == 3 and max(got) == 198


@pytest.mark.parametrize("summed", [3, 10**6])
def test_exact_quantiles_equal_the_builtin(spark, scratch, summed):
    rng = random.Random(7)
    rows = []
    for size in [1, 2, 3, 4, 5, 99, 100, 101, 200, 1000, 5000]:
        for _ in range(size):
            x = rng.choice([None, float("nan"), -0.0, 1e300, rng.gauss(0, 1), float(rng.randrange(5))])
            rows.append((dt.date(2000, 1, 1) + dt.timedelta(size), x, rng.randrange(-(2**62), 2**62)))
    df = dated(spark, rows, "x double, n bigint")
    wanted = {"x": [0.5, 0.99], "n": [0.5, 0.01]}
    got = group_quantiles(df, wanted, ["snapshot_date"], scratch=scratch, summed=summed)
    clean = df.withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    disc = "percentile_disc({}) WITHIN GROUP (ORDER BY {})"
    want = clean.groupBy("snapshot_date").agg(
        F.expr(disc.format(0.5, "x")).alias("x_p50"), F.expr(disc.format(0.99, "x")).alias("x_p99")
    )
    columns = ["snapshot_date", "x_p50", "x_p99"]
    assert sorted(got.select(columns).collect(), key=str) == sorted(
        want.select(columns).collect(), key=str
    )
    # Longs beyond 2**53 must not pass through double.
    groups: dict = {}
    for day, _, n in rows:
        groups.setdefault(day, []).append(n)
    for r in got.collect():
        values = sorted(groups[r["snapshot_date"]])
        assert r["n_p50"] == values[max(math.ceil(len(values) * 0.5), 1) - 1]
        assert r["n_p1"] == values[max(math.ceil(len(values) * 0.01), 1) - 1]


@pytest.mark.parametrize("summed", [3, 10**6])
def test_exact_quantiles_with_a_dominant_value_and_null_group(spark, scratch, summed):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(JAN)).alias("snapshot_date"),
        F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.col("id").cast("double")).alias("x"),
    )
    qs = [0.1, 0.5, 0.99]
    got = group_quantiles(df, {"x": qs}, ["snapshot_date"], scratch=scratch, summed=summed)
    disc = [F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY x)") for q in qs]
    builtin = df.groupBy("snapshot_date").agg(*disc).collect()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, builtin), key=str)
    assert len(builtin) == 2


@pytest.mark.parametrize("q", [0.07, 0.14, 0.29, 0.57, 0.58, 0.01, 0.99, 1.0, 0.0])
def test_ranks_are_those_of_the_written_decimal(spark, scratch, q):
    sizes = [1, 2, 7, 50, 100, 300]
    rows = [(dt.date(2000, 1, 1) + dt.timedelta(n), i + 1) for n in sizes for i in range(n)]
    got = group_quantiles(dated(spark, rows, "x int"), {"x": [q]}, ["snapshot_date"], scratch=scratch)
    from fractions import Fraction

    exact = [max(math.ceil(n * Fraction(repr(q))), 1) for n in sizes]
    assert [r[1] for r in got.orderBy("snapshot_date").collect()] == exact


def test_exact_quantiles_need_a_folder_and_leave_nothing(spark):
    df = dated(spark, [(JAN, 1), (JAN, None)], "x int")
    with pytest.raises(ValueError, match="scratch"):
        impute.fill_median(df, ["x"])
    from pathlib import Path

    with Scratch(spark) as own:
        assert impute.fill_median(df, ["x"], scratch=own).count() == 2
        assert Path(own.root).exists()
    assert not Path(own.root).exists()


def test_a_bad_sketch_only_costs_another_pass(spark, scratch, monkeypatch):
    from ledgerloom.operators import quantiles

    df = spark.range(20_000).select(F.lit(JAN).alias("snapshot_date"), (F.col("id") * 7919 % 20_011).alias("x"))
    want = group_quantiles(df, {"x": [0.5, 0.99]}, ["snapshot_date"], scratch=scratch).collect()
    monkeypatch.setattr(quantiles, "_SKETCH", 8)
    monkeypatch.setattr(quantiles, "_MARGINS", (0.0, 1.0))
    tried = []
    select = quantiles._select_exact
    monkeypatch.setattr(quantiles, "_select_exact", lambda *a: tried.append(select(*a)) or tried[-1])
    assert group_quantiles(df, {"x": [0.5, 0.99]}, ["snapshot_date"], scratch=scratch).collect() == want
    assert tried[0] is None and len(tried) == 2


def test_quantiles_of_several_types_take_two_passes(spark, scratch, monkeypatch):
    """Sketches once, counts once, whatever the types; none for columns of few values."""
    from decimal import Decimal

    rng = random.Random(3)
    rows = [
        (rng.choice([JAN, FEB, None]), rng.randrange(2**60), rng.gauss(0, 1), Decimal(rng.randrange(10**6)) / 100, rng.choice([1, 2, None]))
        for _ in range(4000)
    ]
    df = dated(spark, rows, "n bigint, x double, d decimal(20,2), k int")
    staged = []
    real = Scratch.stage
    monkeypatch.setattr(Scratch, "stage", lambda self, out, name, **o: staged.append(name) or real(self, out, name, **o))
    wanted = {"n": [0.5, 0.07], "x": [0.99], "d": [0.14], "k": [0.5]}
    got = group_quantiles(df, wanted, ["snapshot_date"], scratch=scratch, few=["k"]).collect()
    assert staged == ["brackets", "bracket-counts"]
    for r in got:
        for name, qs in wanted.items():
            values = sorted(v for day, *rest in rows if day == r[0] and (v := rest["nxdk".index(name)]) is not None)
            for q in qs:
                rank = max(math.ceil(len(values) * Decimal(str(q))), 1)
                assert r[f"{name}_p{q * 100:g}"] == values[rank - 1]
    assert len(got) == 3
    staged.clear()
    few = group_quantiles(df, {"k": [0.5]}, ["snapshot_date"], scratch=scratch, few=["k"])
    assert staged == ["bracket-counts"]
    assert sorted(map(repr, few.collect())) == sorted(repr(r) for r in group_quantiles(df, {"k": [0.5]}, ["snapshot_date"], scratch=scratch).collect())


def test_sketches_are_merged_in_two_levels(spark):
    df = spark.range(0, 40_000, 1, 16).select(F.lit(JAN).alias("snapshot_date"), (F.col("id") * 7919 % 40_009).alias("x"))
    got = group_quantiles(df, {"x": [0.5, 0.07]}, ["snapshot_date"], accuracy=100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "__salt" in plan
    n, exact = 40_000, sorted(r.x for r in df.collect())
    (row,) = got.collect()
    for q, value in ((0.5, row.x_p50), (0.07, row.x_p7)):
        assert abs(exact.index(value) - q * n) <= n / 100
    with pytest.raises(ValueError, match="accuracy"):
        group_quantiles(df, {"x": [0.5]}, ["snapshot_date"], accuracy=10**6)


def test_fills(spark):
    df = dated(spark, [(JAN, None, None, None), (FEB, 1, float("nan"), "a")], "i int, d double, s string")
    assert impute.fill_constants(df, {"i": 0, "s": 0}).orderBy("snapshot_date").first()[1:] == (0, None, "0")
    rows = impute.fill_all_numeric(df).orderBy("snapshot_date").collect()
    assert [tuple(r)[1:] for r in rows] == [(0, 0.0, None), (1, 0.0, "a")]


def test_enforce_schema(spark):
    df = spark.createDataFrame([("1.5", 2.9, "x")], "a string, b double, c string")
    lenient = conform.enforce_schema(df, {"a": "int", "b": "int", "gone": "date"})
    assert lenient.first().asDict() == {"a": 1, "b": 2, "c": "x"}
    with pytest.raises(ValueError, match="gone"):
        conform.enforce_schema(df, {"a": "int", "gone": "date"}, strict=True)


LEDGER = [
    # installment, due, overdue, missed, first missed, dpd, label
    (6, 100.0, 0.0, 0, None, 0, 0),
    (6, 100.0, 100.0, 1, dt.date(2023, 6, 1), 30, 1),
    (6, 100.0, 150.0, 2, dt.date(2023, 5, 1), 61, 1),
    (6, 0.0, 50.0, 0, None, None, 0),
    (6, 100.0, None, 0, None, 0, 0),
    (6, 100.0, -50.0, 0, None, 0, 0),
    (6, 100.0, -150.0, -1, None, 0, 0),
    (5, 100.0, 300.0, 3, dt.date(2023, 4, 1), 91, None),
]


def ledger(spark, rows, snapshot):
    return spark.createDataFrame(
        [(str(i), "c", None, 10, n, 1000.0, due, 0.0, over, 0.0, snapshot) for i, (n, due, over) in enumerate(rows)],
        ", ".join(f"{k} {v}" for k, v in LOAN_DAILY.items()),
    )


def test_ledger_golden_rows(spark):
    enriched = labels.enrich_ledger(ledger(spark, [r[:3] for r in LEDGER], dt.date(2023, 7, 1)))
    got = enriched.orderBy("loan_id").select("installments_missed", "first_missed_date", "dpd").collect()
    assert [tuple(r) for r in got] == [r[3:6] for r in LEDGER]
    store = labels.build_labels(enriched, dpd=30, mob=6).orderBy("loan_id").collect()
    assert [r["label"] for r in store] == [r[6] for r in LEDGER if r[6] is not None]
    assert {r["label_def"] for r in store} == {"30dpd_6mob"}


def test_month_length_matters(spark):
    enriched = labels.enrich_ledger(ledger(spark, [(6, 100.0, 100.0)], dt.date(2023, 3, 1)))
    assert enriched.first()["dpd"] == 28
    assert labels.build_labels(enriched, dpd=30, mob=6).first()["label"] == 0


def test_ledger_schema_is_strict(spark):
    with pytest.raises(ValueError, match="balance"):
        labels.enrich_ledger(ledger(spark, [(6, 1.0, 1.0)], JAN).drop("balance"))


VALUES = [(JAN, i, v) for i, v in enumerate(["a", "b", "b", "c", None])]

def test_index_and_one_hot(spark, scratch):
    df = dated(spark, [*VALUES, (FEB, 5, "c"), (FEB, 6, None)], "i int, x string")
    levels = encode.fit_levels(df, ["x"], scratch)
    index = encode.index_columns(df, levels).orderBy("i").collect()
    assert [r["x_index"] for r in index] == [1, 0, 0, 2, 3, 0, 1]
    vectors = encode.with_vectors(encode.one_hot_columns(df, levels), ["x_ohe"], scratch)
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert not any(f in plan for f in ("from_json", "to_json", "UDF", "Project"))
    assert [(r.x_ohe.size, r.x_ohe.indices.tolist()) for r in vectors.orderBy("i").collect()] == [
        (3, [1]), (3, [0]), (3, [0]), (3, [2]), (3, []), (1, [0]), (1, []),
    ]
    later = encode.index_columns(df, encode.frozen(levels, JAN, [JAN, FEB])).orderBy("i").collect()
    assert [r["x_index"] for r in later] == [1, 0, 0, 2, 3, 2, 3]
    hot = encode.one_hot_columns(df, levels).withColumn("x", encode.dense(F.col("x_ohe")))
    assert [r["x"] for r in hot.orderBy("i").collect()] == [
        [0, 1, 0],
        [1, 0, 0],
        [1, 0, 0],
        [0, 0, 1],
        [0, 0, 0],
        [1],
        [0],
    ]


def test_levels_of_an_empty_or_all_null_column(spark, scratch):
    df = dated(spark, [(JAN, 0, None)], "i int, x string")
    levels = encode.fit_levels(df, ["x"], scratch)
    row = encode.one_hot_columns(df, levels).first()
    assert row["x_ohe"].asDict() == {"size": 0, "slot": None}


def test_unseen_values_get_the_last_index(spark, scratch):
    levels = encode.fit_levels(dated(spark, VALUES, "i int, x string"), ["x"], scratch)
    other = dated(spark, [(JAN, 0, "new"), (FEB, 1, "a")], "i int, x string")
    got = encode.index_columns(other, levels).orderBy("i").collect()
    assert [r["x_index"] for r in got] == [3, 0]


def test_skip_and_min_max(spark):
    df = dated(
        spark,
        [(JAN, 1.0, 5), (JAN, 3.0, 5), (JAN, None, 5), (JAN, float("nan"), 5), (JAN, 2.0, 5)],
        "x double, y int",
    )
    complete = scale.skip_incomplete(df, ["x", "y"])
    got = sorted(
        (r["x"], r["x_scaled"], r["y_scaled"]) for r in scale.scale_min_max(complete, ["x", "y"]).collect()
    )
    assert got == [(1.0, 0.0, 0.5), (2.0, 0.5, 0.5), (3.0, 1.0, 0.5)]


def test_salted_join_equals_the_plain_one(spark, scratch):
    # Half of the rows, and all copies of one row, share a key.
    rows = scratch.stage(
        spark.range(20_000).select(
            F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("Customer_ID"),
            (F.col("id") % 4).alias("v"),
        ),
        "rows",
    )
    side = rows.select("Customer_ID").distinct().withColumn("s", F.length("Customer_ID"))
    several = scratch.stage(
        side.withColumn("t", F.explode(F.sequence(F.lit(1), F.when(F.col("s") == 3, 30).otherwise(2)))).drop("s"),
        "several",
    )
    tables = [rows, side, several]
    counts = scratch.stage(joins.key_counts(tables), "counts")
    count = lambda df: sorted(map(tuple, df.groupBy("Customer_ID", "v", "s", "t").count().collect()))
    plain = joins.feature_join(rows, [side, several])
    want = count(plain)
    assert sum(r[-1] for r in want) == counts.agg(F.sum("joined")).first()[0] > 300_000
    for pieces in (1, 3, 50, 100_000):
        hot = joins.hot_keys(counts, pieces=pieces)
        assert hot.count() <= pieces and (pieces < 3 or hot.count())
        salted = joins.feature_join(rows, [side, several], hot=hot)
        assert sorted(plain.columns) == sorted(salted.columns)
        assert count(salted) == want


def test_no_task_holds_more_than_its_share_of_the_product(spark, scratch):
    """A key that is short in each table, but not in their product, is cut up."""
    key = F.when(F.col("id") % 25 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("Customer_ID")
    tables = [
        scratch.stage(spark.range(n).select(key, F.col("id").alias(c)), c)
        for n, c in ((2500, "a"), (750, "b"), (250, "c"))
    ]
    counts = scratch.stage(joins.key_counts(tables), "counts")
    pieces = 40
    hot = joins.hot_keys(counts, pieces=pieces)
    salts = hot.first()
    assert salts["Customer_ID"] == "hot" and hot.count() == 1
    total = counts.agg(F.sum("joined")).first()[0]
    assert total > 100 * 30 * 10
    held = joins.feature_join(tables[0], tables[1:], hot=hot)
    assert held.count() == total
    parts = 1
    for i in range(3):
        parts *= salts[f"salts_{i}"]
    assert parts >= pieces - 1
    share = 1.0
    for i, n in enumerate((100, 30, 10)):
        share *= -(-n // salts[f"salts_{i}"])
    assert share <= 2 * total / pieces


def test_as_of_join(spark):
    days = [dt.date(2023, m, 1) for m in range(1, 5)]
    rows = dated(spark, [(days[0], "k"), (days[2], "k"), (days[3], "k"), (days[3], "other")], "Customer_ID string")
    side = dated(spark, [(days[1], "k", 1), (days[2], "k", 2), (days[2], "k", 3), (None, "k", 9)], "Customer_ID string, v int")
    got = joins.as_of_join(rows, [side])
    assert sorted(map(tuple, got.select("snapshot_date", "v").collect())) == [(days[2], 3), (days[3], 3)]


def as_of_by_hand(rows, sides):
    out = []
    for when, key, *own in rows:
        found = []
        for side in sides:
            past = [r for r in side if r[1] == key and r[0] and when and r[0] <= when]
            if key is None or not past:
                break
            found += max(past)[2:]
        else:
            out.append((when, key, *own, *found))
    return sorted(out, key=repr)


@pytest.mark.parametrize("pieces", [None, 3, 40])
def test_as_of_join_of_a_hot_customer(spark, scratch, pieces):
    """Equal to a search by hand, salted or not; rows spread over their salts."""
    rng = random.Random(11)
    days = [None, *[dt.date(2023, m, 1) for m in range(1, 9)]]

    def table(n, high):
        return [
            (rng.choice(days), rng.choice(["hot"] * 6 + ["a", "b", "c", None]), rng.randrange(high), rng.randrange(high))
            for _ in range(n)
        ]

    rows, one, two = table(400, 1000), table(25, 9), table(12, 9)
    frames = [
        scratch.stage(dated(spark, t, f"Customer_ID string, {n}1 int, {n}2 int").repartition(3), n)
        for t, n in ((rows, "r"), (one, "s"), (two, "t"))
    ]
    hot = None
    if pieces:
        hot = joins.hot_keys(scratch.stage(joins.key_counts(frames[:1]), "counts"), pieces=pieces)
        assert {r[0]: r[1] for r in hot.collect()}["hot"] > 1
    got = joins.as_of_join(frames[0], frames[1:], hot=hot)
    assert sorted(map(tuple, got.collect()), key=repr) == as_of_by_hand(rows, [one, two])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and plan.count("Window [") == 1


def test_rules_keep_every_row(spark, scratch):
    df = dated(spark, [(JAN, 1), (JAN, None), (None, 5), (None, None)], "x int")
    got = impute.fill_median(df, ["x"], scratch=scratch)
    assert got.count() == 4 and got.where("x IS NULL").count() == 0
