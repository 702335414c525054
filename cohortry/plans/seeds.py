"""Seed cohorts: brand shoppers selected by keyword, period, frequency and recency."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortry.functions import codes, keyword_match, month_filter
from cohortry.operators import ids_with_min_rows, prune_months, recent_ids, ref_date

NAME_COLUMNS = ("merchant_description", "store_name", "brand_name")


def rfm_reference(rfm: DataFrame) -> date | None:
    return ref_date(rfm, "rfm_ref_date")


def brand_rows(fact: DataFrame, keywords: Sequence[str], ref: date, lookback_months: int,
               include_months=None, exclude_months=None, exclude_range=None, channel=None,
               name_cols: Sequence[str] = NAME_COLUMNS, date_col: str = "trans_date") -> DataFrame:
    """Transactions with the brand in ``[ref - lookback, ref]`` that pass the calendar filters."""
    d = F.col(date_col)
    end = F.lit(ref).cast("date")
    rows = prune_months(fact, ref, ref, months_back=lookback_months) \
        .where((d >= F.add_months(end, -lookback_months)) & (d < F.date_add(end, 1)))
    if include_months or exclude_months or exclude_range:
        rows = rows.where(month_filter(d, include_months, exclude_months, exclude_range))
    if channel:
        rows = rows.where(F.col("transaction_channel") == channel)
    return rows.where(keyword_match(name_cols, keywords))


def seed_ids(fact: DataFrame, keywords: Sequence[str], ref: date, lookback_months: int = 12,
             min_transactions: int = 1, include_months=None, exclude_months=None,
             exclude_range: tuple[str, str] | None = None, channel: str | None = None,
             rfm: DataFrame | None = None, max_recency: int | None = None,
             id_col: str = "individual_id") -> DataFrame:
    """Ids only: people with at least ``min_transactions`` qualifying transactions.

    ``max_recency`` (days, needs ``rfm``) keeps people whose last transaction is more recent.
    """
    rows = brand_rows(fact, keywords, ref, lookback_months, include_months, exclude_months,
                      exclude_range, channel)
    ids = ids_with_min_rows(rows, id_col, min_transactions)
    return ids if max_recency is None else recent_ids(rfm, ids, id_col, max_recency)


def preset(name: str, **overrides) -> dict:
    """Arguments for :func:`seed_ids` from a named preset."""
    args = {k: v for k, v in codes.SEED_PRESETS[name].items() if k != "target"}
    return {**args, **overrides}


def seed_grid(fact: DataFrame, rfm: DataFrame, keywords: Sequence[str], ref: date,
              min_transactions: Sequence[int] = tuple(codes.SEED_MIN_TRANSACTIONS),
              max_recency: int = codes.SEED_MAX_RECENCY_DAYS,
              lookbacks: Sequence[int] = tuple(codes.SEED_LOOKBACK_MONTHS),
              id_col: str = "individual_id", **filters) -> DataFrame:
    """Seed size for every (lookback, minimum, recency screen), from one scan of the fact."""
    rows = brand_rows(fact, keywords, ref, max(lookbacks), **filters) \
        .where(F.col(id_col).isNotNull())
    end = F.lit(ref).cast("date")
    per_id = rows.groupBy(id_col).agg(*[
        F.count_if(F.col("trans_date") >= F.add_months(end, -m)).alias(f"_n{m}")
        for m in lookbacks])
    recent = rfm.select(id_col, (F.col("days_since_last_txn") < max_recency).alias("_recent"))
    per_id = per_id.join(recent, id_col, "left")
    cells = [(m, k, r) for m in lookbacks for k in min_transactions for r in (None, max_recency)]
    sizes = per_id.agg(*[
        F.count_if((F.col(f"_n{m}") >= k) & (F.lit(True) if r is None else F.col("_recent")))
         .alias(f"c{i}") for i, (m, k, r) in enumerate(cells)])
    return sizes.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("lookback_months"), F.lit(k).alias("min_transactions"),
                 F.lit(r).cast("int").alias("max_recency"), F.col(f"c{i}").alias("seed_size"))
        for i, (m, k, r) in enumerate(cells)])))


@dataclass(frozen=True)
class SeedChoice:
    lookback_months: int
    min_transactions: int
    max_recency: int | None
    seed_size: int
    in_target: bool


def choose_seed(grid: DataFrame, target: tuple[int, int]) -> DataFrame:
    """The row of ``grid`` that :func:`tune_seed` chooses, with ``in_target``, found in the plan.

    The settings on the way from loose to tight are numbered; the walk ends at the first that is not above the
    range, and goes one back if that is below it.
    """
    low, high = target
    whole = Window.partitionBy()  # a grid has a few dozen rows
    loosest, tightest = F.max("lookback_months").over(whole), F.max("min_transactions").over(whole)
    screen = F.max("max_recency").over(whole)
    marked = grid.select("*", loosest.alias("_m"), tightest.alias("_k"), screen.alias("_r"))
    screened = (F.col("min_transactions") == F.col("_k")) & F.col("max_recency").eqNullSafe(F.col("_r"))
    on_way = (((F.col("lookback_months") == F.col("_m")) & F.col("max_recency").isNull()) | screened)
    order = Window.orderBy(F.desc("lookback_months"), F.col("max_recency").asc_nulls_first(), "min_transactions")
    steps = marked.where(on_way).withColumn("_step", F.row_number().over(order))
    stop = F.min(F.when(F.col("seed_size") <= high, F.col("_step"))).over(whole)
    last = F.max("_step").over(whole)
    steps = steps.withColumn("_stop", F.coalesce(stop, last))
    size = F.max(F.when(F.col("_step") == F.col("_stop"), F.col("seed_size"))).over(whole)
    chosen = F.greatest(F.lit(1), F.when(size < low, F.col("_stop") - 1).otherwise(F.col("_stop")))
    return steps.withColumn("_chosen", chosen).where("_step = _chosen").select(
        "lookback_months", "min_transactions", "max_recency", "seed_size",
        F.col("seed_size").between(low, high).alias("in_target"))


def tune_seed(grid: DataFrame, target: tuple[int, int]) -> SeedChoice:
    """First setting, from loose to tight, whose size is in the target range.

    Tightening raises the minimum, then adds the recency screen, then shortens the look-back.  If no
    setting fits, the one just above the range is kept, or the loosest when all are below.
    """
    return SeedChoice(**choose_seed(grid, target).first().asDict())
