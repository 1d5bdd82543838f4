"""Backfill of a range of months, layer by layer.

Each layer is a handful of jobs over all requested snapshots at once; the
number of jobs and of source scans does not depend on the number of months.  The
tables of a layer do not depend on each other and run side by side, so a layer
takes as long as its longest table.

A whole lake is made of tables several times as large as their sources, so what is
only on its way takes little disk: rows are regrouped through files, and a job's
shuffle files go when it ends.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.audit import row_counts
from ledgerloom.plans import bronze, gold, silver
from ledgerloom.plans.bronze import FEATURE_TABLES, LEDGER_TABLE, table_path
from ledgerloom.plans.calendar import month_starts
from ledgerloom.plans.gold import FeatureRules
from ledgerloom.plans.silver import CleaningRules
from ledgerloom.sources.jobs import brief_shuffles, side_by_side
from ledgerloom.sources.snapshots import read_snapshots

LAYERS = ("bronze", "silver", "gold")
TABLES = {
    "bronze": [*FEATURE_TABLES, LEDGER_TABLE],
    "silver": [*FEATURE_TABLES, LEDGER_TABLE],
    "gold": ["feature_store", "label_store"],
}


def backfill(
    spark: SparkSession,
    sources: Mapping[str, str],
    lake: str,
    start: str | dt.date,
    end: str | dt.date,
    *,
    layers: Sequence[str] = LAYERS,
    dpd: int = 30,
    mob: int = 6,
    undated: str = "error",
    choices: CleaningRules = CleaningRules(),
    features: FeatureRules = FeatureRules(),
) -> None:
    """Build ``layers`` for every month start between ``start`` and ``end``.

    ``sources`` maps clickstream, attributes, financials and loan_daily to CSV
    paths.  Running it again replaces the same snapshots and nothing else.
    """
    dates = month_starts(start, end)
    steps = {
        "bronze": {
            "bronze-features": lambda: bronze.ingest_features(spark, sources, lake, dates, undated=undated),
            "bronze-ledger": lambda: bronze.ingest_ledger(spark, sources[LEDGER_TABLE], lake, dates),
        },
        "silver": {
            "silver-features": lambda: silver.refine_features(spark, lake, dates, choices),
            "silver-ledger": lambda: silver.refine_ledger(spark, lake, dates),
        },
        "gold": {
            "gold-features": lambda: gold.publish_features(spark, lake, dates, choices=features, sparing=True),
            "gold-labels": lambda: gold.publish_labels(spark, lake, dates, dpd=dpd, mob=mob),
        },
    }
    with brief_shuffles(spark):
        for layer in LAYERS:
            if layer in layers:
                side_by_side(spark, steps[layer])


def audit(spark: SparkSession, lake: str, layers: Sequence[str] = LAYERS) -> DataFrame:
    """Rows per layer, table and snapshot; reads no column but the partition's."""
    counts = [
        row_counts(read_snapshots(spark, table_path(lake, layer, table))).select(
            F.lit(layer).alias("layer"), F.lit(table).alias("table"), "snapshot_date", "rows"
        )
        for layer in layers
        for table in TABLES[layer]
    ]
    return reduce(DataFrame.unionAll, counts)
