"""Derivations on one row of a loan ledger."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MOST_MISSED = 2**31 - 1
FIRST_DATE = dt.date(1900, 1, 1)


def month_on_book(installment: Column) -> Column:
    return installment.try_cast("int")


def installments_missed(overdue: Column, due: Column) -> Column:
    """Overdue amount in whole instalments, rounded up.

    0 where it is undefined (an amount is absent, or none is due); more than
    an int can hold is the largest int, so that a tiny instalment is never
    taken for nothing missed.
    """
    count = F.ceil(F.try_divide(overdue, due))  # beyond a long, the largest long
    bounded = F.greatest(F.least(count, F.lit(MOST_MISSED)), F.lit(-MOST_MISSED))
    return F.when(count.isNotNull(), bounded.cast("int")).otherwise(F.lit(0))


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    """Snapshot minus ``missed`` calendar months; NULL if nothing was missed.

    Dates before ``FIRST_DATE``, which calendars need not reach, are that date.
    """
    start = F.lit(FIRST_DATE)
    back = (F.year(snapshot) - F.year(start)) * 12 + F.month(snapshot) - F.month(start)
    date = F.add_months(snapshot, -F.least(missed, F.greatest(back, F.lit(0))))
    return F.when(missed > back, start).when(missed > 0, date)


def days_past_due(snapshot: Column, overdue: Column, first_missed: Column) -> Column:
    """Days since the first missed instalment.

    0 if nothing is overdue.  NULL if an amount is overdue but no instalment
    could be derived (due amount 0 or absent).
    """
    return F.when(overdue > 0, F.datediff(snapshot, first_missed)).otherwise(F.lit(0))


def default_label(dpd: Column, threshold: int) -> Column:
    """1 from ``threshold`` days past due on, else 0; an unknown dpd gives 0."""
    return F.when(dpd >= threshold, F.lit(1)).otherwise(F.lit(0))


def label_definition(threshold: int, mob: int) -> Column:
    return F.lit(f"{threshold}dpd_{mob}mob")
