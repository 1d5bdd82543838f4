"""Silver: typed, cleaned tables; every statistic is one of the own snapshot."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions import rules
from ledgerloom.operators.conform import enforce_schema, typed, typed_together
from ledgerloom.operators.impute import fill_constants, with_imputation
from ledgerloom.operators.labels import enrich_ledger
from ledgerloom.plans.bronze import LEDGER_TABLE, table_path
from ledgerloom.sources.jobs import side_by_side
from ledgerloom.sources.scratch import Scratch
from ledgerloom.sources.snapshots import read_snapshots, write_snapshots


@dataclass(frozen=True)
class CleaningRules:
    """Choices that the cleaning rules leave open.

    ``mismatch`` replaces values of the wrong pattern and placeholder
    occupations, ``unknown`` the other missing categories.  ``cards_from`` is
    the column whose median replaces credit card outliers.  ``accuracy``
    selects sketched quantiles instead of exact ones.  ``null_too`` treats a missing
    occupation, credit mix or minimum payment like its placeholders.  ``drop_pii``
    leaves names and social security numbers out of silver, which no later layer
    reads.
    """

    mismatch: str = rules.UNKNOWN
    unknown: str = rules.UNKNOWN
    cards_from: str = "Num_Credit_Card"
    accuracy: int | None = None
    null_too: bool = False
    drop_pii: bool = False


# The published rules to the letter: a misspelt sentinel, and card outliers
# filled with the median number of bank accounts.
PUBLISHED_RULES = CleaningRules(mismatch="Unkonwn", cards_from="Num_Bank_Accounts")


def clean_clickstream(df: DataFrame) -> DataFrame:
    filled = fill_constants(df, {c: 0 for c in schemas.CLICK_COUNTERS if c in df.columns})
    return enforce_schema(filled, schemas.CLICKSTREAM)


def clean_attributes(
    df: DataFrame, choices: CleaningRules = CleaningRules(), scratch: Scratch | None = None
) -> DataFrame:
    """Exact medians are looked up when called, and need ``scratch``."""
    lo, hi = schemas.AGE_RANGE
    parsed = df.withColumns(
        {
            "Age": rules.null_out_of_range(typed(df, "Age", "int", strip="_"), lo, hi),
            "SSN": rules.valid_or(F.col("SSN"), schemas.SSN_PATTERN, choices.mismatch),
            "Occupation": rules.placeholder_to(
                F.col("Occupation"),
                schemas.OCCUPATION_PLACEHOLDERS,
                choices.mismatch,
                trim=True,
                null_too=choices.null_too,
            ),
        }
    )
    if choices.drop_pii:
        parsed = parsed.drop(*schemas.PII_COLUMNS)
    filled = with_imputation(
        parsed, medians=["Age"], accuracy=choices.accuracy, scratch=scratch, few=["Age"]  # integers in AGE_RANGE
    )
    return enforce_schema(filled, schemas.ATTRIBUTES)


def clean_financials(
    df: DataFrame, choices: CleaningRules = CleaningRules(), scratch: Scratch | None = None
) -> DataFrame:
    """Exact statistics are looked up when called, and need ``scratch``; they read
    ``df`` twice, whatever the number and types of the columns."""
    ranged = ("Interest_Rate", "Num_of_Loan", "Num_of_Delayed_Payment", "Num_Credit_Inquiries")
    stripped = {
        **{name: "int" for name in ("Num_of_Loan", "Num_of_Delayed_Payment")},
        **{name: "double" for name in ("Annual_Income", "Outstanding_Debt", "Amount_invested_monthly")},
    }
    plain = {
        **{name: "double" for name in ("Interest_Rate", "Num_Bank_Accounts", "Num_Credit_Card")},
        "Num_Credit_Inquiries": "int",
    }
    numbers = typed_together(typed_together(df, stripped, strip="_"), plain)
    parsed = numbers.withColumns(
        {
            **{
                name: rules.null_out_of_range(F.col(name), *schemas.FINANCIAL_RANGES[name]).try_cast("int")
                for name in ranged
            },
            "Type_of_Loan": rules.null_to(F.col("Type_of_Loan"), choices.unknown),
            "Credit_Mix": rules.placeholder_to(
                F.col("Credit_Mix"), schemas.CREDIT_MIX_PLACEHOLDERS, choices.unknown, null_too=choices.null_too
            ),
            "Payment_of_Min_Amount": rules.placeholder_to(
                F.col("Payment_of_Min_Amount"),
                schemas.MIN_AMOUNT_PLACEHOLDERS,
                choices.unknown,
                null_too=choices.null_too,
            ),
            "Payment_Behaviour": rules.valid_or(
                F.col("Payment_Behaviour"), schemas.PAYMENT_BEHAVIOUR_PATTERN, choices.mismatch
            ),
        }
    )
    filled = with_imputation(
        parsed,
        medians=list(ranged),
        outliers={"Num_Bank_Accounts": "Num_Bank_Accounts", "Num_Credit_Card": choices.cards_from},
        accuracy=choices.accuracy,
        scratch=scratch,
        few=list(ranged),  # integers in FINANCIAL_RANGES
    )
    return enforce_schema(filled, schemas.FINANCIALS)


def refine_features(
    spark: SparkSession,
    lake: str,
    dates: Sequence[str | dt.date] | None = None,
    choices: CleaningRules = CleaningRules(),
) -> None:
    """Bronze features to silver, the tables side by side.

    Bronze is laid out by snapshot and nothing here moves rows, so the write
    needs no shuffle either.
    """
    with Scratch(spark) as scratch:
        cleaners = {
            "clickstream": clean_clickstream,
            "attributes": lambda df: clean_attributes(df, choices, scratch),
            "financials": lambda df: clean_financials(df, choices, scratch),
        }

        def refine(table: str) -> None:
            raw = read_snapshots(spark, table_path(lake, "bronze", table), dates=dates)
            write_snapshots(
                cleaners[table](raw), table_path(lake, "silver", table), dates=dates, clustered=True
            )

        side_by_side(spark, {f"silver-{table}": partial(refine, table) for table in cleaners})


def refine_ledger(
    spark: SparkSession, lake: str, dates: Sequence[str | dt.date] | None = None
) -> None:
    raw = read_snapshots(spark, table_path(lake, "bronze", LEDGER_TABLE), dates=dates)
    write_snapshots(
        enrich_ledger(raw), table_path(lake, "silver", LEDGER_TABLE), dates=dates, clustered=True
    )
