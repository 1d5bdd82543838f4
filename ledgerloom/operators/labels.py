"""Loan ledger to default labels; narrow from scan to sink, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import ledger
from ledgerloom.operators.conform import enforce_schema
from ledgerloom.operators.impute import fill_all_numeric
from ledgerloom.schemas import LOAN_DAILY


def enrich_ledger(df: DataFrame) -> DataFrame:
    """Typed ledger plus ``mob, installments_missed, first_missed_date, dpd``.

    The zero fill comes after ``installments_missed``, which needs the original
    NULLs, and before ``dpd``, which compares filled amounts.
    """
    counted = enforce_schema(df, LOAN_DAILY, strict=True).withColumns(
        {
            "mob": ledger.month_on_book(F.col("installment_num")),
            "installments_missed": ledger.installments_missed(F.col("overdue_amt"), F.col("due_amt")),
        }
    )
    filled = fill_all_numeric(counted, 0)
    first_missed = ledger.first_missed_date(F.col("snapshot_date"), F.col("installments_missed"))
    return filled.withColumn("first_missed_date", first_missed).withColumn(
        "dpd",
        ledger.days_past_due(F.col("snapshot_date"), F.col("overdue_amt"), F.col("first_missed_date")),
    )


def build_labels(df: DataFrame, *, dpd: int, mob: int) -> DataFrame:
    """Label every loan at month on book ``mob``: 1 from ``dpd`` days past due."""
    return df.where(F.col("mob") == mob).select(
        "loan_id",
        "Customer_ID",
        ledger.default_label(F.col("dpd"), dpd).alias("label"),
        ledger.label_definition(dpd, mob).alias("label_def"),
        "snapshot_date",
    )
