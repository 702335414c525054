"""Finding groups too large for one task.

One key may hold a large part of all rows.  Aggregates with a fixed-size buffer (sums, counts,
extremes) survive that through Spark's map-side combine.  Joins and set-valued aggregates do not, so
they deal such groups out.  Groups are counted exactly, and those found are a table that is joined, of at
most one row for every ``min_rows`` rows: no list of keys is brought to the driver and none is left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .materialise import materialise

GROUP_ROWS = 1_000_000


def large_groups(df: DataFrame, keys: Sequence[str], min_rows: int = GROUP_ROWS) -> DataFrame:
    """The keys (as ``_large_<key>``) of groups of at least ``min_rows`` rows, NULLs included, and in
    ``_slices`` how many parts of about that size their rows make.

    ``min_rows`` is what one task is to hold at most, so it does not grow with the table.  One pass over the
    key columns, whose counts are combined before they are shuffled.
    """
    counts = df.groupBy(*[F.col(k).alias(f"_large_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    return materialise(counts.where(F.col("_n") >= min_rows).select(
        *[f"_large_{k}" for k in keys], F.ceil(F.col("_n") / min_rows).cast("bigint").alias("_slices")))


def same_group(keys: Sequence[str]) -> Column:
    """Join condition of rows with their entry in :func:`large_groups`."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_large_{k}")) for k in keys])
