"""Recency, frequency and monetary features."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.functions import codes, ratio
from cohortry.operators import prune_months, windowed_aggs
from cohortry.operators import ref_date as latest_date


def rfm_features(fact: DataFrame, ref_date: date | None = None,
                 windows: Sequence[int] = codes.RFM_WINDOWS,
                 id_col: str = "individual_id", date_col: str = "trans_date",
                 amount: str = "trans_amount", channel: str = "transaction_channel",
                 brand: str = "brand_name") -> DataFrame:
    """One row per person active in the widest window ending at ``ref_date`` (default: latest date).

    Pinning ``ref_date`` keeps a holdout period out of the features.
    """
    ref = ref_date or latest_date(fact, date_col)
    if ref is None:  # an empty fact has no reference date and no features
        ref, fact = date(1970, 1, 1), fact.limit(0)
    widest = max(windows)
    fact = prune_months(fact, ref, ref, months_back=widest)
    base = windowed_aggs(fact, id_col, date_col, amount, ref, windows,
                         online=F.col(channel) == "ONLINE", brand=brand)
    return base.select(
        id_col, F.lit(ref).cast("date").alias("rfm_ref_date"), "last_txn_date",
        F.datediff(F.lit(ref).cast("date"), "last_txn_date").alias("days_since_last_txn"),
        *[c for c in base.columns if c not in (id_col, "last_txn_date")],
        ratio(f"tot_online_trans_{widest}mo", f"tot_trans_{widest}mo")
        .alias(f"online_ratio_{widest}mo"))


def rfm_segments(rfm: DataFrame, id_col: str = "individual_id") -> DataFrame:
    """Trend, cadence class and channel mix read off the features.

    A cadence of 30 to 60 days belongs to no class.
    """
    trend = ratio("tot_trans_3mo", "tot_trans_12mo")
    days = F.col("avg_days_btwn_trans_12mo")
    online = ratio("tot_online_trans_12mo", "tot_trans_12mo")
    return rfm.select(
        id_col, trend.alias("trend_ratio"),
        F.coalesce(trend > 0.4, F.lit(False)).alias("is_accelerating"),
        F.when(days < 7, "weekly").when(days < 30, "monthly").when(days > 60, "infrequent")
         .alias("cadence"),
        online.alias("online_ratio"))
