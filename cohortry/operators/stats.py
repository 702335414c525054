"""Seed-versus-population statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.functions.scalars import ratio


def numeric_profile(df: DataFrame, is_seed: str, cols: Sequence[str]) -> DataFrame:
    """One row per feature: mean and sample deviation over the seed and over everybody.

    A single pass: each person becomes one (feature, value) row per feature, and those combine into
    ``len(cols)`` groups before anything is shuffled.  An empty population gives no rows.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"))
                      for c in cols])
    seed = F.col("_seed") == 1
    in_seed = F.when(seed, F.col("x"))
    return df.select(F.col(is_seed).alias("_seed"), F.inline(pairs)).groupBy("feature").agg(
        F.count_if(seed).alias("n_seeds"), F.count(F.lit(1)).alias("n_population"),
        F.avg(in_seed).alias("seed_mean"), F.stddev_samp(in_seed).alias("seed_std"),
        F.avg("x").alias("pop_mean"), F.stddev_samp("x").alias("pop_std"))


def category_shares(df: DataFrame, is_seed: str, cols: Sequence[str]) -> DataFrame:
    """Share of each category value within the seed and within the population, per field.

    Columns: field, value, seed_count, pop_count, seed_share (NULL when no seed has the value),
    pop_share.  NULL values are left out of both numerator and denominator.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value"))
                      for c in cols])
    counts = (df.select(F.col(is_seed).alias("_seed"), F.inline(pairs))
                .where(F.col("value").isNotNull())
                .groupBy("field", "value")
                .agg(F.count_if(F.col("_seed") == 1).alias("seed_count"),
                     F.count(F.lit(1)).alias("pop_count")))
    # at most len(cols) rows, so broadcasting the totals is bounded whatever the data
    totals = counts.groupBy("field").agg(F.sum("seed_count").alias("_seed_total"),
                                         F.sum("pop_count").alias("_pop_total"))
    return counts.join(F.broadcast(totals), "field").select(
        "field", "value", "seed_count", "pop_count",
        F.when(F.col("seed_count") > 0, ratio("seed_count", "_seed_total")).alias("seed_share"),
        ratio("pop_count", "_pop_total").alias("pop_share"))


def category_importance(shares: DataFrame, floor: float = 0.1) -> DataFrame:
    """Per field: the peak over-representation of any value in the seed, at least ``floor``."""
    peak = F.max(F.try_divide("seed_share", "pop_share"))
    return shares.groupBy("field").agg(
        F.greatest(F.coalesce(peak, F.lit(0.0)), F.lit(floor)).alias("importance"))
