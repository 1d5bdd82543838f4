"""Gold: the feature store and the label store."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions import rules
from ledgerloom.operators.encode import (
    Levels,
    count_tuples,
    levels_of_tuples,
    look_up,
    number_levels,
    one_hot_columns,
    with_vectors,
)
from ledgerloom.operators.joins import as_of_join, feature_join, hot_keys, key_counts
from ledgerloom.operators.labels import build_labels
from ledgerloom.operators.profile import JoinProfile, profile_join
from ledgerloom.operators.scale import assemble, assemble_scaled, fit_min_max, skip_incomplete
from ledgerloom.plans.bronze import LEDGER_TABLE, table_path
from ledgerloom.schemas import CUSTOMER, SNAPSHOT
from ledgerloom.sources.jobs import side_by_side
from ledgerloom.sources.scratch import Scratch
from ledgerloom.sources.snapshots import read_snapshots, write_snapshots


@dataclass(frozen=True)
class FeatureRules:
    """Choices of the derived features; the defaults are the published ones.

    ``exact_loans`` flags a loan type only where an entry of the list is it, not
    where it is part of a longer name.  ``missing_as_zero`` takes a credit history
    of years or months alone as it stands, instead of as unknown.
    """

    exact_loans: bool = False
    missing_as_zero: bool = False


def derive_financials(df: DataFrame, choices: FeatureRules = FeatureRules()) -> DataFrame:
    """Loan type flags and credit history in months, instead of their texts."""
    loans, age = F.col("Type_of_Loan"), F.col("Credit_History_Age")
    return df.withColumns(
        {
            **{
                schemas.flag_name(term): rules.membership_flag(loans, term, exact=choices.exact_loans)
                for term in schemas.LOAN_TYPES
            },
            "Credit_History_Month": rules.duration_months(age, missing_as_zero=choices.missing_as_zero),
        }
    ).drop("Credit_History_Age")


def _sides(
    attributes: DataFrame, financials: DataFrame, choices: FeatureRules = FeatureRules()
) -> list[DataFrame]:
    """What gold needs of the side tables, derived before any join."""
    return [
        df.drop(*schemas.IDENTIFYING_COLUMNS) for df in (attributes, derive_financials(financials, choices))
    ]


def join_features(
    clickstream: DataFrame,
    attributes: DataFrame,
    financials: DataFrame,
    *,
    as_of: bool = False,
    hot: DataFrame | None = None,
    choices: FeatureRules = FeatureRules(),
) -> DataFrame:
    """Each clickstream row with every attribute and financial row of its customer.

    The side tables take part with all their snapshots, as published.  With
    ``as_of`` they take part with their latest row that is not after the
    click's snapshot: one result row per click, and nothing from its future.
    ``hot`` is that of the joins: of all tables, or with ``as_of`` of clickstream.
    """
    sides = _sides(attributes, financials, choices)
    if as_of:
        return as_of_join(clickstream, sides, hot=hot)
    return feature_join(clickstream, [df.drop(SNAPSHOT) for df in sides], hot=hot)


def profile(clickstream: DataFrame, sides: Sequence[DataFrame], scratch: Scratch) -> JoinProfile:
    """The stored statistics from which the store's fits follow."""
    return profile_join(
        clickstream, sides, scratch, numeric=schemas.NUMERIC_FEATURES, categories=schemas.CATEGORIES
    )


def encode_features(
    joined: DataFrame, levels: Levels, limits: DataFrame, tuples: Sequence[DataFrame] = ()
) -> DataFrame:
    """One-hot vectors, assembled and scaled numerics of ``joined``, whose rows are complete."""
    numeric = schemas.NUMERIC_FEATURES
    return (
        one_hot_columns(joined, levels, alongside=limits, tuples=tuples)
        .withColumns(
            {
                "numeric_features": assemble(numeric),
                "scaled_numeric_features": assemble_scaled(numeric),
            }
        )
        .drop(*limits.drop(SNAPSHOT).columns)
    )


def build_features(
    clickstream: DataFrame,
    attributes: DataFrame,
    financials: DataFrame,
    scratch: Scratch,
    *,
    as_of: bool = False,
    choices: FeatureRules = FeatureRules(),
    sparing: bool = False,
) -> DataFrame:
    """The feature store of all snapshots of ``clickstream``.

    Vocabularies are those of all joined rows; rows with an incomplete numeric
    feature are then dropped, and the scaling limits are those of the rest.
    Both follow from the tables' profiles, so the joined rows exist once, on
    their way into the result: joined with salts for hot customers and regrouped
    by snapshot while they are narrow.  Each table is read twice, for its profile
    and for the join.  With ``as_of`` rows do not multiply, and the fits read the
    stored join.  The result reads from ``scratch``: store it before discarding
    that.  The tables should be read from files.

    ``sparing`` regroups the joined rows through files, which takes less than half of
    a shuffle's disk, and frees the joins' shuffles before the store grows; it takes
    longer.
    """
    spark, categories = scratch.spark, schemas.CATEGORIES
    if as_of:
        hot = scratch.stage(hot_keys(scratch.stage(key_counts([clickstream]), "key-counts")), "hot-keys")
        some = None if hot.isEmpty() else hot
        joined = join_features(clickstream, attributes, financials, as_of=True, hot=some, choices=choices)
        joined = scratch.stage(joined, "joined", cluster_by=SNAPSHOT)
        complete = skip_incomplete(joined, schemas.NUMERIC_FEATURES)
        limits = fit_min_max(complete, schemas.NUMERIC_FEATURES)
        fitted = side_by_side(
            spark,
            {
                "limits": lambda: scratch.stage(limits, "limits"),
                "tuples": lambda: scratch.stage(count_tuples(joined, categories), "tuples"),
            },
        )
        counted = [fitted["tuples"]]
        limits = fitted["limits"]
    else:
        sides = [df.drop(SNAPSHOT) for df in _sides(attributes, financials, choices)]
        found = profile(clickstream, sides, scratch)
        fitted = side_by_side(
            spark,
            {
                "hot": lambda: scratch.stage(hot_keys(scratch.stage(found.key_counts(), "key-counts")), "hot-keys"),
                "limits": lambda: scratch.stage(found.totals().drop("joined", "kept"), "limits"),
                **{
                    f"tuples-{i}": lambda i=i: scratch.stage(found.tuples(i), f"tuples-{i}")
                    for i in range(len(sides))
                },
            },
        )
        counted = [fitted[f"tuples-{i}"] for i in range(len(sides))]
        limits, hot = fitted["limits"], fitted["hot"]
        joined = feature_join(clickstream, sides, hot=None if hot.isEmpty() else hot)
        complete = skip_incomplete(joined, schemas.NUMERIC_FEATURES)
        if sparing:
            complete = scratch.regroup(complete, "joined", SNAPSHOT)
        else:
            complete = complete.hint("rebalance", F.col(SNAPSHOT))
    counts = reduce(DataFrame.unionAll, [levels_of_tuples(t) for t in counted])
    levels = number_levels(counts, categories, scratch)
    tuples = side_by_side(
        spark,
        {
            f"look-up-{i}": lambda i=i, t=t: scratch.stage(look_up(t, levels), f"look-up-{i}")
            for i, t in enumerate(counted)
        },
    )
    return encode_features(complete, levels, limits, list(tuples.values()))


def audit_dropped(
    clickstream: DataFrame,
    attributes: DataFrame,
    financials: DataFrame,
    scratch: Scratch,
    *,
    choices: FeatureRules = FeatureRules(),
) -> DataFrame:
    """Per snapshot, ``joined`` rows and how many are ``dropped`` as incomplete."""
    sides = [df.drop(SNAPSHOT) for df in _sides(attributes, financials, choices)]
    totals = profile(clickstream, sides, scratch).totals()
    return totals.select(SNAPSHOT, "joined", (F.col("joined") - F.col("kept")).alias("dropped"))


def as_vectors(features: DataFrame, scratch: Scratch) -> DataFrame:
    """One-hot codes and numeric arrays as ML vectors, for estimators that want
    them; one-hot vectors are sparse, whatever their width.  The result reads from
    ``scratch``."""
    return with_vectors(features, [f"{c}_ohe" for c in schemas.CATEGORIES], scratch).withColumns(
        {c: array_to_vector(c) for c in ("numeric_features", "scaled_numeric_features")}
    )


def publish_features(
    spark: SparkSession,
    lake: str,
    dates: Sequence[str | dt.date] | None = None,
    *,
    as_of: bool = False,
    choices: FeatureRules = FeatureRules(),
    sparing: bool = False,
) -> DataFrame:
    """Silver features to the feature store; returns the stored snapshots."""
    path = table_path(lake, "gold", "feature_store")

    def silver(table, days=None):
        return read_snapshots(spark, table_path(lake, "silver", table), dates=days)

    with Scratch(spark) as scratch:
        features = build_features(
            silver("clickstream", dates),
            silver("attributes"),
            silver("financials"),
            scratch,
            as_of=as_of,
            choices=choices,
            sparing=sparing,
        )
        write_snapshots(features, path, dates=dates, clustered=True)
    return read_snapshots(spark, path, dates=dates)


def publish_labels(
    spark: SparkSession,
    lake: str,
    dates: Sequence[str | dt.date] | None = None,
    *,
    dpd: int,
    mob: int,
) -> DataFrame:
    """Silver ledger to the label store; returns the stored snapshots.

    Labels are few and narrow rows of many ledger files: they are regrouped by
    snapshot, or every ledger task would leave a small file.
    """
    path = table_path(lake, "gold", "label_store")
    ledger = read_snapshots(spark, table_path(lake, "silver", LEDGER_TABLE), dates=dates)
    write_snapshots(build_labels(ledger, dpd=dpd, mob=mob), path, dates=dates)
    return read_snapshots(spark, path, dates=dates)
