"""Join shapes: dimension lookups, membership labels, semi joins, version selection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import same_group

NULL_SPREAD = 1_024


def left_enrich(fact: DataFrame, dim: DataFrame, on: Sequence[str], spread_by: Sequence[str] = (),
                large: DataFrame | None = None) -> DataFrame:
    """Left-outer lookup of ``dim`` on equally named keys; one copy of the keys remains.

    No broadcast hint: Catalyst broadcasts by measured size (statistics, then AQE's shuffle sizes).
    NULL keys never match but would all hash to one task, so with ``spread_by`` they are dealt out
    by a hash of those columns.  ``large`` (from :func:`large_groups`) also deals out keys with many rows, in
    as many slices as these rows need; their few dimension rows are repeated once per slice.  The slice is a
    hash of row content, so a recomputed task gives the same answer.
    """
    on = list(on)
    if not spread_by:
        return fact.join(dim, on, "left")
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    content = F.xxhash64(*[F.col(c) for c in spread_by])
    slice_ = F.when(any_null, F.pmod(content, F.lit(NULL_SPREAD)) + 1)
    # 0 for every row, but not a literal: the optimiser would turn a literal into a filter on the
    # fact's slice and leave it out of the hash partitioning
    zero = F.pmod(F.xxhash64(*on), F.lit(1))
    if large is not None:
        marks = [f"_large_{k}" for k in on]
        fact, dim = (df.join(large, same_group(on), "left").drop(*marks) for df in (fact, dim))
        slice_ = slice_.when(F.col("_slices").isNotNull(), F.pmod(content, F.col("_slices")) + 1)
        slices = F.when(F.col("_slices").isNotNull(), F.sequence(zero + 1, zero + F.col("_slices"))) \
                  .otherwise(F.array(zero))
        dim = dim.withColumn("_slice", F.explode(slices)).drop("_slices")
    else:
        dim = dim.withColumn("_slice", zero)
    fact = fact.withColumn("_slice", slice_.otherwise(F.lit(0).cast("bigint"))).drop("_slices")
    return fact.join(dim, on + ["_slice"], "left").drop("_slice")


def membership(labelled_ids: Sequence[tuple[str, DataFrame]], id_col: str, out: str) -> DataFrame:
    """One row per id with the first label (in list order) whose id list contains it."""
    ranked = [ids.select(F.col(ids.columns[0]).alias(id_col), F.lit(rank).alias("_rank"))
              for rank, (_, ids) in enumerate(labelled_ids)]
    first = reduce(DataFrame.unionAll, ranked).where(F.col(id_col).isNotNull()) \
        .groupBy(id_col).agg(F.min("_rank").alias("_rank"))
    labels = F.array(*[F.lit(label) for label, _ in labelled_ids])
    return first.select(id_col, labels[F.col("_rank")].alias(out))


def label_membership(df: DataFrame, id_col: str, labelled_ids: Sequence[tuple[str, DataFrame]],
                     out: str, spread_by: Sequence[str] = ()) -> DataFrame:
    """Adds ``out``: the label of the first id list holding the row's id, else NULL.

    The lists are reduced to one row per id first, so repeated ids never multiply rows.
    """
    if not labelled_ids:
        return df.withColumn(out, F.lit(None).cast("string"))
    return left_enrich(df, membership(labelled_ids, id_col, out), [id_col], spread_by)


def latest_version(lookup: DataFrame, metadata: DataFrame, key: str = "audience_id",
                   version: str = "ver") -> DataFrame:
    """Rows of ``lookup`` whose version is the latest one ``metadata`` records for the key, in their own
    columns.  A NULL key matches nothing.

    The latest versions are one row per key; Spark broadcasts them by their size or splits hot keys.
    """
    latest = metadata.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(version).alias(version)) \
        .where(F.col(version).isNotNull())
    return lookup.join(latest, [key, version], "left_semi").select(*lookup.columns)


def active_ids(fact: DataFrame, ids: DataFrame, id_col: str, date_col: str, start=None,
               end=None) -> DataFrame:
    """Ids with at least one row in the half-open range."""
    from cohortry.functions import in_range
    hits = fact.where(in_range(date_col, start, end)).select(id_col).distinct()
    return ids.select(id_col).distinct().join(hits, id_col, "left_semi")


def recent_ids(rfm: DataFrame, ids: DataFrame, id_col: str, max_days: int,
               recency: str = "days_since_last_txn") -> DataFrame:
    """Ids whose last transaction is less than ``max_days`` before the reference date."""
    return ids.join(rfm.where(F.col(recency) < max_days).select(id_col), id_col, "left_semi")
