"""Daily per-person summary of the transaction fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.operators import GROUP_ROWS, newer_than, prune_months, summarise

LIST_COLUMNS = ["merchant_description", "merchant_category_code", "merchant_city",
                "merchant_state", "merchant_zip", "merchant_country", "store_name", "brand_name",
                "store_type", "brand_type", "brand_tagging_classification", "transaction_channel",
                "store_city", "store_state", "store_zip", "store_country"]
DISTINCT_COLUMNS = {"mtid": "unique_merchant_count", "store_id": "unique_store_count",
                    "brand_id": "unique_brand_count", "merchant_category_code": "unique_mcc_count",
                    "transaction_channel": "unique_channel_count"}
MODE_COLUMNS = ["trans_time_zone", "card_type", "card_zip", "areaid"]


def amount_metrics(amount: str = "trans_amount") -> dict:
    return {
        "experiment_group": F.max("experiment_group"),
        "transaction_count": F.count(F.lit(1)),
        "total_transaction_amount": F.sum(amount),
        "avg_transaction_amount": F.avg(amount),
        "min_transaction_amount": F.min(amount),
        "max_transaction_amount": F.max(amount),
        "latest_delivery_date": F.max("transaction_delivery_date"),
        "earliest_delivery_date": F.min("transaction_delivery_date"),
    }


def daily_summary(fact: DataFrame, since=None, id_col: str = "individual_id",
                  split_from: int | None = GROUP_ROWS, ranged: bool = False) -> DataFrame:
    """One row per (trans_date, person): 35 columns of totals, modes, lists and distinct counts.

    ``since`` keeps only later dates (incremental run).  A narrow pass finds the groups of at least
    ``split_from`` rows; those are aggregated value by value, the others in one step.  None says that
    there are no such groups.  ``ranged`` gives the others in tasks that are ranges of date and person, so that a
    table clustered by these needs no further shuffle; it reads ``fact`` once more, for a sample of the keys.
    """
    rows = fact.where(F.col(id_col).isNotNull())
    if since is not None:
        rows = newer_than(prune_months(rows, since), "trans_date", since)
    return _summarised(rows, "trans_date", F.col("trans_date"), id_col, split_from, ranged)


def daily_summary_stream(fact: DataFrame, delay: str = "2 days", id_col: str = "individual_id") -> DataFrame:
    """:func:`daily_summary` of a stream of fact rows, for an update-mode sink keyed by date and person.

    A person's day is a state: running totals, how often each value of a mode's column came, and the different
    value tuples that feed lists and distinct counts.  A batch emits the days it changed, whole, so late rows
    correct what was written before.  A day is dropped from the state once the watermark, the latest date less
    ``delay``, has passed it; later rows of that day are left out.  Days do not depend on the session's time zone.
    """
    seconds = F.unix_date("trans_date").cast("bigint") * 86_400
    rows = fact.where(F.col(id_col).isNotNull()).withColumn("_day", F.timestamp_seconds(seconds)) \
        .withWatermark("_day", delay)
    day = F.date_from_unix_date(F.floor(F.unix_seconds("_day") / 86_400).cast("int"))
    return _summarised(rows, "_day", day, id_col, None)


def _summarised(rows: DataFrame, day_col: str, day, id_col: str, split_from: int | None,
                ranged: bool = False) -> DataFrame:
    out = summarise(rows, [day_col, id_col], amount_metrics(),
                    mode_cols={c: c for c in MODE_COLUMNS}, distinct_cols=DISTINCT_COLUMNS,
                    list_cols={c: f"{c}_str_list" for c in LIST_COLUMNS}, split_from=split_from,
                    ranged=ranged)
    return out.select(
        day.alias("trans_date"), id_col, "experiment_group", "transaction_count", "total_transaction_amount",
        "avg_transaction_amount", "min_transaction_amount", "max_transaction_amount",
        "trans_time_zone", "latest_delivery_date", "earliest_delivery_date", "card_type",
        "card_zip", "areaid", *[f"{c}_str_list" for c in LIST_COLUMNS], *DISTINCT_COLUMNS.values())
