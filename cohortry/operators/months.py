"""Month folders of the stored fact.

Readers filter on the transaction date.  On a fact stored by month the helper adds the matching filter
on the folder column, so whole folders are left out before a single file footer is read.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONTH = "trans_month"


def month_text(day: date, months_back: int = 0) -> str:
    n = day.year * 12 + day.month - 1 - months_back
    return f"{n // 12:04d}-{n % 12 + 1:02d}"


def with_month(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumn(MONTH, F.date_format(date_col, "yyyy-MM"))


def prune_months(df: DataFrame, first: date | None = None, last: date | None = None,
                 months_back: int = 0) -> DataFrame:
    """Rows of the months from ``first`` (less ``months_back``) to ``last``, where known."""
    if MONTH not in df.columns:
        return df
    if first is not None:
        df = df.where(F.col(MONTH) >= month_text(first, months_back))
    return df if last is None else df.where(F.col(MONTH) <= month_text(last))
