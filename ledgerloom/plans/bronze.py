"""Bronze: raw CSV to Parquet by snapshot, one scan per source.

Rows are regrouped by snapshot through files: as text they are several times as
large in a shuffle as in compressed columns.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ledgerloom import schemas
from ledgerloom.schemas import SNAPSHOT
from ledgerloom.sources.csv import read_csv
from ledgerloom.sources.jobs import side_by_side
from ledgerloom.sources.scratch import Scratch
from ledgerloom.sources.snapshots import snapshot_slice, write_snapshots

FEATURE_TABLES = {
    "clickstream": schemas.CLICKSTREAM,
    "attributes": schemas.ATTRIBUTES,
    "financials": schemas.FINANCIALS,
}
LEDGER_TABLE = "loan_daily"


def table_path(lake: str, layer: str, table: str) -> str:
    return f"{lake.rstrip('/')}/{layer}/{table}"


def _store(raw: DataFrame, lake: str, table: str, dates: Sequence[str | dt.date]) -> None:
    with Scratch(raw.sparkSession) as scratch:
        rows = scratch.regroup(raw, table, SNAPSHOT)
        write_snapshots(rows, table_path(lake, "bronze", table), dates=dates, clustered=True)


def ingest_features(
    spark: SparkSession,
    sources: Mapping[str, str],
    lake: str,
    dates: Sequence[str | dt.date],
    *,
    undated: str = "error",
) -> None:
    """Ingest the feature sources, a CSV path per table name, side by side."""

    def ingest(table: str) -> None:
        raw = snapshot_slice(read_csv(spark, sources[table], FEATURE_TABLES[table]), dates, undated=undated)
        _store(raw, lake, table, dates)

    side_by_side(spark, {f"bronze-{table}": partial(ingest, table) for table in FEATURE_TABLES})


def ingest_ledger(
    spark: SparkSession, source: str, lake: str, dates: Sequence[str | dt.date]
) -> None:
    raw = snapshot_slice(read_csv(spark, source, schemas.LOAN_DAILY), dates)
    _store(raw, lake, LEDGER_TABLE, dates)
