"""Range, pattern, placeholder and text rules for one column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.schemas import LIST_PATTERN, MONTHS_PATTERN, YEARS_PATTERN

UNKNOWN = "Unknown"


def null_out_of_range(c: Column, lo, hi) -> Column:
    """Values outside ``[lo, hi]`` become NULL, the bounds are kept."""
    return F.when(c.between(lo, hi), c)


def valid_or(c: Column, pattern: str, sentinel: str = UNKNOWN) -> Column:
    """Values that do not match ``pattern``, and NULLs, become ``sentinel``."""
    return F.when(c.rlike(pattern), c).otherwise(F.lit(sentinel))


def placeholder_to(
    c: Column,
    values: Sequence[str],
    sentinel: str = UNKNOWN,
    *,
    trim: bool = False,
    null_too: bool = False,
) -> Column:
    """Placeholder spellings become ``sentinel``; NULL stays NULL, or with ``null_too``
    becomes it as well."""
    probe = F.trim(c) if trim else c
    out = F.when(probe.isin(list(values)), F.lit(sentinel)).otherwise(c)
    return null_to(out, sentinel) if null_too else out


def null_to(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))


def membership_flag(c: Column, term: str, *, exact: bool = False) -> Column:
    """``Yes`` if the text contains ``term`` (case-sensitive), else ``No``.

    With ``exact`` the text is a list (``A, B, and C``) of which one entry must be
    the term, so that a term inside a longer one does not count.
    """
    found = F.array_contains(F.split(F.trim(c), LIST_PATTERN), term) if exact else c.contains(term)
    return F.when(found, F.lit("Yes")).otherwise(F.lit("No"))


def duration_months(c: Column, *, missing_as_zero: bool = False) -> Column:
    """``"X Years and Y Months"`` as months; NULL unless both parts are there.

    With ``missing_as_zero`` one part is enough.
    """
    parts = [F.regexp_extract(c, pattern, 1).try_cast("int") for pattern in (YEARS_PATTERN, MONTHS_PATTERN)]
    if not missing_as_zero:
        return parts[0] * 12 + parts[1]
    years, months = (F.coalesce(part, F.lit(0)) for part in parts)
    return F.when(F.coalesce(*parts).isNotNull(), years * 12 + months)
