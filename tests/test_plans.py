"""Layers end to end on dirty CSVs, and the shape of the physical plans."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.ml.linalg import DenseVector, SparseVector
from pyspark.sql import functions as F

from checks import queries as q
from checks.raw import raw
from conftest import SF_DIR
from ledgerloom import schemas
from ledgerloom.operators.audit import duplicate_keys
from ledgerloom.operators.joins import hot_keys
from ledgerloom.plans import backfill, bronze, gold, silver
from ledgerloom.plans.bronze import table_path
from ledgerloom.plans.calendar import calendar, month_starts
from ledgerloom.sources.csv import read_csv
from ledgerloom.sources.scratch import Scratch
from ledgerloom.sources.snapshots import (
    legacy_path,
    read_legacy_snapshots,
    read_snapshots,
    snapshot_directories,
    snapshot_slice,
    write_snapshots,
)

TABLES = [*bronze.FEATURE_TABLES, bronze.LEDGER_TABLE]


@pytest.fixture(scope="module")
def run(spark):
    """A full backfill: its sources and its lake."""
    scratch = Scratch(spark)
    sources = q._csv_sources(spark, SF_DIR, scratch, TABLES)
    lake = scratch.path("lake")
    backfill.backfill(spark, sources, lake, "2023-01-01", "2024-12-01")
    return sources, lake


def content(df):
    return sorted(str(sorted(r.asDict(recursive=True).items())) for r in df.collect())


GOLD = ["feature_store", "label_store"]


def test_rerun_gives_the_same_lake(spark, run):
    sources, lake = run
    before = {t: content(read_snapshots(spark, table_path(lake, "gold", t))) for t in GOLD}
    backfill.backfill(spark, sources, lake, "2023-01-01", "2024-12-01")
    for table, rows in before.items():
        assert content(read_snapshots(spark, table_path(lake, "gold", table))) == rows
        assert rows


def stored(spark, lake, layer, table, day):
    path = table_path(lake, layer, table)
    if day not in snapshot_directories(spark, path):
        return []
    return content(read_snapshots(spark, path, dates=[day]))


def test_month_by_month_equals_one_pass(spark, run):
    sources, lake = run
    other = Scratch(spark).path("lake")
    months = [dt.date(2023, 2, 1), dt.date(2024, 1, 1)]
    backfill.backfill(spark, sources, other, "2023-01-01", "2024-12-01", layers=["bronze"])
    for month in months:
        backfill.backfill(spark, sources, other, month, month, layers=["silver"])
    for table in TABLES:
        for month in months:
            assert stored(spark, other, "silver", table, month) == stored(spark, lake, "silver", table, month)
    # Gold joins side tables of all months, so it is repeated on the full lake.
    whole = stored(spark, lake, "gold", "feature_store", months[0])
    gold.publish_features(spark, lake, months[:1])
    assert stored(spark, lake, "gold", "feature_store", months[0]) == whole != []


def test_hot_customers_do_not_change_the_store(spark, run, monkeypatch):
    _, lake = run
    month = dt.date(2023, 5, 1)
    whole = stored(spark, lake, "gold", "feature_store", month)
    found = []

    def many_pieces(counts):
        found.append(hot_keys(counts, pieces=10_000))
        return found[-1]

    monkeypatch.setattr(gold, "hot_keys", many_pieces)
    gold.publish_features(spark, lake, [month])
    assert found
    assert stored(spark, lake, "gold", "feature_store", month) == whole != []


def test_a_month_without_rows_is_not_an_error(spark, run):
    _, lake = run
    path = table_path(lake, "gold", "feature_store")
    before = read_snapshots(spark, path).count()
    assert gold.publish_features(spark, lake, ["2030-01-01"]).count() == 0
    assert gold.publish_labels(spark, lake, ["2030-01-01"], dpd=30, mob=6).count() == 0
    assert read_snapshots(spark, path).count() == before


def test_feature_store_schema(spark, run, scratch):
    _, lake = run
    store = read_snapshots(spark, table_path(lake, "gold", "feature_store"))
    dropped = {*schemas.CATEGORIES, *schemas.IDENTIFYING_COLUMNS, "Credit_History_Age"}
    assert not dropped & set(store.columns)
    assert {f"{c}_ohe" for c in schemas.CATEGORIES} <= set(store.columns)
    assert {*schemas.NUMERIC_FEATURES, "numeric_features", "scaled_numeric_features"} <= set(store.columns)
    row = gold.as_vectors(store, scratch).first()
    assert isinstance(row["scaled_numeric_features"], DenseVector) and row["numeric_features"].size == 37
    assert isinstance(row["Credit_Mix_ohe"], SparseVector)
    assert row["Credit_Mix_ohe"].size >= 2


def test_feature_store_invariants(spark, run):
    _, lake = run
    store = read_snapshots(spark, table_path(lake, "gold", "feature_store"))
    scaled = F.forall("scaled_numeric_features", lambda x: (x >= 0) & (x <= 1))
    assert store.where(~scaled).count() == 0
    for c in schemas.CATEGORIES:
        assert store.where(~F.col(f"{c}_ohe.slot").between(0, F.col(f"{c}_ohe.size") - 1)).count() == 0


def test_silver_values_are_in_range(spark, run):
    _, lake = run
    fin = read_snapshots(spark, table_path(lake, "silver", "financials"))
    for name, (lo, hi) in schemas.FINANCIAL_RANGES.items():
        assert fin.where(~F.col(name).between(lo, hi)).count() == 0
    assert {k: v for k, v in fin.dtypes} == schemas.FINANCIALS


def test_sketched_quantiles_stay_close(spark, scratch):
    exact = silver.clean_attributes(raw(spark, SF_DIR, "attributes"), scratch=scratch)
    sketch = silver.clean_attributes(
        raw(spark, SF_DIR, "attributes"), silver.CleaningRules(accuracy=100)
    )
    assert exact.count() == sketch.count()
    assert sketch.where(F.col("Age").isNull()).count() == 0


def test_calendar(spark):
    dates = month_starts("2023-01-15", "2024-12-01")
    assert len(dates) == 24 and dates[0] == dt.date(2023, 1, 1) and dates[-1] == dt.date(2024, 12, 1)
    table = calendar(spark, "2023-01-15", "2024-12-01")
    assert [r[0] for r in table.orderBy("snapshot_date").collect()] == dates


def test_undated_table(spark):
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError, match="snapshot_date"):
        snapshot_slice(df, ["2023-01-01"])
    assert snapshot_slice(df, ["2023-01-01", "2023-02-01"], undated="replicate").count() == 2


def test_overwrite_touches_only_requested_snapshots(spark, scratch):
    path = scratch.path("t")
    rows = [(1, dt.date(2023, 1, 1)), (2, dt.date(2023, 2, 1)), (3, dt.date(2023, 3, 1))]
    df = spark.createDataFrame(rows, "x int, snapshot_date date")
    write_snapshots(df, path)
    # February is rewritten, March is rewritten with nothing, January is left.
    write_snapshots(
        df.where("x = 2").withColumn("x", F.lit(20)), path, dates=["2023-02-01", "2023-03-01"]
    )
    got = sorted(tuple(r) for r in read_snapshots(spark, path, df.schema).collect())
    assert got == [(1, dt.date(2023, 1, 1)), (20, dt.date(2023, 2, 1))]


def test_a_large_snapshot_is_written_by_several_tasks(spark, scratch):
    path = scratch.path("skewed")
    day = F.when(F.col("id") % 10 < 9, F.lit("2023-01-01")).otherwise(F.lit("2023-02-01"))
    df = spark.range(0, 400_000, 1, 8).select(F.rand(1).alias("x"), day.cast("date").alias("snapshot_date"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        write_snapshots(df, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    back = read_snapshots(spark, path, df.schema).withColumn("file", F.input_file_name())
    files = back.groupBy("snapshot_date").agg(
        F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("rows")
    )
    large, small = files.orderBy("snapshot_date").collect()
    assert large["rows"] == 360_000 and small["rows"] == 40_000
    assert large["files"] > 2


def test_writing_no_rows_keeps_a_readable_table(spark, scratch):
    path = scratch.path("empty")
    df = spark.createDataFrame([], "x int, snapshot_date date")
    write_snapshots(df, path, dates=["2023-01-01", "2023-02-01"])
    back = read_snapshots(spark, path)
    assert back.dtypes == df.dtypes and back.count() == 0


def test_legacy_layout(spark, scratch):
    df = spark.createDataFrame([(1,)], "x int")
    for month in ["2023-01-01", "2023-02-01"]:
        df.write.parquet(legacy_path(scratch.root, "silver_attributes", month, "parquet"))
    assert legacy_path("d/", "t", "2023-01-01", "csv") == "d/t_2023_01_01.csv"
    assert read_legacy_snapshots(spark, scratch.root, "silver_attributes").count() == 2
    assert read_legacy_snapshots(spark, scratch.root, "silver_attributes", dates=["2023-01-01"]).count() == 1
    df.write.option("header", True).csv(legacy_path(scratch.root, "bronze_attributes", "2023-01-01", "csv"))
    text = read_legacy_snapshots(spark, scratch.root, "bronze_attributes", suffix="csv")
    assert text.dtypes == [("x", "string")] and text.count() == 1


def test_csv_places_columns_by_header(spark, scratch, tmp_path):
    (tmp_path / "t.csv").write_text('extra,snapshot_date,Age\nx,2023-01-01,23_\n,oops,""\n')
    df = read_csv(spark, str(tmp_path / "t.csv"), schemas.ATTRIBUTES)
    assert df.dtypes == [("extra", "string"), ("snapshot_date", "date"), ("Age", "string")]
    assert [tuple(r) for r in df.collect()] == [("x", dt.date(2023, 1, 1), "23_"), (None, None, None)]


# --- plan shapes ------------------------------------------------------------


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [
    name
    for name in q.QUERIES
    if not name.startswith(("q_backfill", "q_partitioned", "q_interrupted", "q_csv", "q_feature_store"))
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(q.QUERIES[name](spark, SF_DIR))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ScalaUDF"):
        assert bad not in text


@pytest.mark.parametrize("name", ["q_label_store", "q_ledger_dpd", "q_clean_ledger", "q_clean_clickstream"])
def test_narrow_plans_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(q.QUERIES[name](spark, SF_DIR))


def test_statistics_are_broadcast(spark, scratch):
    text = plan(silver.clean_attributes(raw(spark, SF_DIR, "attributes"), scratch=scratch))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_labels_of_many_tasks_are_few_files(spark, scratch):
    lake = scratch.path("lake")
    days = F.expr("make_date(2024, cast(1 + id % 6 AS int), 1)")
    ledger = spark.range(0, 6000, 1, 24).select(
        F.col("id").cast("string").alias("loan_id"), F.lit("c").alias("Customer_ID"), F.lit(6).alias("mob"),
        F.lit(0).alias("dpd"), days.alias("snapshot_date"),
    )
    write_snapshots(ledger, table_path(lake, "silver", "loan_daily"), clustered=True)
    gold.publish_labels(spark, lake, dpd=30, mob=6)
    stored_files = read_snapshots(spark, table_path(lake, "gold", "label_store")).inputFiles()
    assert len(stored_files) == 6


def test_regrouping_needs_adaptive_execution(spark, scratch):
    df = spark.createDataFrame([(1, dt.date(2023, 1, 1))], "x int, snapshot_date date")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with pytest.raises(ValueError, match="adaptive"):
            write_snapshots(df, scratch.path("t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_duplicate_keys_are_counted(spark, scratch):
    """Rows of one customer and snapshot multiply the store, so they are audited."""
    rows = [("a", dt.date(2023, 1, 1)), ("a", dt.date(2023, 1, 1)), ("b", dt.date(2023, 1, 1)), ("a", None)]
    df = spark.createDataFrame(rows, "Customer_ID string, snapshot_date date")
    assert [tuple(r) for r in duplicate_keys(df, ["Customer_ID", "snapshot_date"]).collect()] == [
        ("a", dt.date(2023, 1, 1), 2)
    ]


def test_label_scan_is_pruned_and_pushed_down(spark, run):
    _, lake = run
    ledger = read_snapshots(
        spark, table_path(lake, "silver", "loan_daily"), dates=["2023-03-01"]
    )
    from ledgerloom.operators.labels import build_labels

    text = plan(build_labels(ledger, dpd=30, mob=6))
    assert "EqualTo(mob,6)" in text
    assert "PartitionFilters: [isnotnull(snapshot_date" in text
    assert "loan_amt" not in text


def test_csv_snapshot_filter_reaches_the_scan(spark, run):
    sources, _ = run
    df = snapshot_slice(read_csv(spark, sources["loan_daily"], schemas.LOAN_DAILY), ["2023-03-01"])
    assert "EqualTo(snapshot_date" in plan(df) or "In(snapshot_date" in plan(df)
