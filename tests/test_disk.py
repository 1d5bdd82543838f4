"""What plans leave on disk while they run."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

from conftest import SF_DIR
from pyspark.sql import functions as F

from checks import queries as q
from checks.raw import raw
from ledgerloom.plans import backfill, bronze
from ledgerloom.plans.bronze import table_path
from ledgerloom.sources import scratch as scratch_module
from ledgerloom.sources.csv import read_csv
from ledgerloom.sources.jobs import CLEAN_UP, brief_shuffles
from ledgerloom.sources.scratch import Scratch
from ledgerloom.sources.snapshots import read_snapshots


def shuffle_files(spark) -> set[str]:
    """Of this local session."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {str(f) for folder in folders for f in Path(str(folder)).rglob("shuffle_*")}


def rows_of(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_regrouped_rows_are_the_same_without_a_shuffle(spark, scratch, monkeypatch):
    monkeypatch.setattr(scratch_module, "TASK_BYTES", 64 << 10)
    day = F.when(F.col("id") % 10 < 8, F.lit(dt.date(2023, 1, 1))).when(F.col("id") % 10 == 8, F.lit(dt.date(2023, 2, 1)))
    df = spark.range(0, 100_000, 1, 8).select(day.alias("day"), (F.col("id") % 1000).alias("x"), F.rand(1).alias("y"))
    out = scratch.regroup(df, "t", "day")
    assert out.dtypes == df.dtypes and rows_of(out.select("day", "x")) == rows_of(df.select("day", "x"))
    by_task = out.groupBy(F.spark_partition_id().alias("task")).agg(
        F.collect_set(F.coalesce(F.col("day").cast("string"), F.lit("none"))).alias("days")
    )
    tasks = [r.days for r in by_task.collect()]
    assert all(len(days) <= 2 for days in tasks) and tasks.count(["2023-01-01"]) > 2
    plan = out._jdf.queryExecution().executedPlan().toString()
    # code is made once, whatever the number of values
    assert "Exchange" not in plan and plan.count("ColumnarToRow") == 1 and plan.count("Scan parquet") == 3
    none = scratch.regroup(df.limit(0), "none", "day")
    assert none.dtypes == df.dtypes and none.count() == 0


def test_a_backfill_leaves_no_shuffle_files(spark, scratch):
    sources = q._csv_sources(spark, SF_DIR, scratch, [*bronze.FEATURE_TABLES, bronze.LEDGER_TABLE])
    before = shuffle_files(spark)
    backfill.backfill(spark, sources, scratch.path("lake"), "2023-01-01", "2024-12-01")
    assert not shuffle_files(spark) - before
    assert spark.conf.get(CLEAN_UP, "false") == "false"


def test_the_setting_is_put_back_by_the_last(spark):
    before = spark.conf.get(CLEAN_UP, None)
    with brief_shuffles(spark):
        with brief_shuffles(spark):
            assert spark.conf.get(CLEAN_UP) == "true"
        assert spark.conf.get(CLEAN_UP) == "true"
    assert spark.conf.get(CLEAN_UP, None) == before


def test_bronze_moves_rows_through_files_alone(spark, scratch):
    """Text rows take several times as much in a shuffle as in compressed columns."""
    table = bronze.LEDGER_TABLE
    sources = q._csv_sources(spark, SF_DIR, scratch, [table])
    tracker, group = spark.sparkContext.statusTracker(), "bronze-ledger-test"
    spark.sparkContext.setJobGroup(group, group)
    bronze.ingest_ledger(spark, sources[table], scratch.path("lake"), ["2023-01-01", "2024-01-01"])
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(group)]
    assert stages and max(stages) == 1  # a shuffle would make two
    got = read_snapshots(spark, table_path(scratch.path("lake"), "bronze", table))
    wanted = read_csv(spark, sources[table], {"snapshot_date": "date"}).where("month(snapshot_date) = 1")
    assert rows_of(got.select("loan_id", "loan_amt")) == rows_of(wanted.select("loan_id", "loan_amt"))
    assert got.count() > 0
    assert all(".zstd." in f for f in got.inputFiles())


def test_sources_are_compressed_and_whole(spark, scratch):
    (path,) = q._csv_sources(spark, SF_DIR, scratch, ["financials"]).values()
    names = [f.name for f in Path(path).glob("part-*")]
    assert names and all(n.endswith(".csv.gz") for n in names)
    given = raw(spark, SF_DIR, "financials").select("Customer_ID", "Type_of_Loan")
    assert rows_of(read_csv(spark, path, {}).select(*given.columns)) == rows_of(given)


def test_the_audit_drops_its_sources_once_bronze_holds_them(spark, monkeypatch):
    made = []
    monkeypatch.setattr(q, "Scratch", lambda session: made.append(Scratch(session)) or made[-1])
    seen = []
    real = backfill.backfill

    def spied(session, sources, lake, *args, layers=backfill.LAYERS, **kw):
        seen.append((tuple(layers), Path(made[0].path("csv")).exists()))
        return real(session, sources, lake, *args, layers=layers, **kw)

    monkeypatch.setattr(q.plan, "backfill", spied)
    assert q.QUERIES["q_backfill_audit"](spark, SF_DIR).count() > 0
    assert seen == [(("bronze",), True), (("silver", "gold"), False)]


def test_the_sparing_store_is_the_same(spark, scratch):
    silver = q._silver(spark, SF_DIR, scratch)
    plain, sparing = (q.flat(q.gold.build_features(*silver, scratch, sparing=s)) for s in (False, True))
    assert rows_of(sparing) == rows_of(plain)
    by_task = sparing.groupBy(F.spark_partition_id()).agg(F.count_distinct("snapshot_date").alias("days"))
    assert by_task.agg(F.max("days")).first()[0] <= 3
