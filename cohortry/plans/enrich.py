"""The denormalised transaction fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.operators import label_membership, large_groups, left_enrich

MERCHANT = {"merch_desc": "merchant_description", "mcc": "merchant_category_code",
            "merch_city": "merchant_city", "merch_state": "merchant_state",
            "merch_zip": "merchant_zip", "merch_country": "merchant_country"}
TAGGING = {"store_id": "store_id", "brand_id": "brand_id", "channel": "transaction_channel",
           "locationid": "locationid"}
TAXONOMY = ["store_name", "brand_name", "store_type", "brand_type", "brand_tagging_classification"]
LOCATION = {"address": "store_address", "city": "store_city", "state": "store_state",
            "zip": "store_zip", "country": "store_country", "est_open_date": "store_open_date",
            "est_close_date": "store_close_date"}


def terminal_dimension(merchant: DataFrame, tagging: DataFrame, taxonomy: DataFrame,
                       location: DataFrame, dedupe_tags: bool = False) -> DataFrame:
    """Everything known about a terminal, keyed by ``_terminal``.

    Merchant and tag rows are matched in a full outer join, so looking a transaction up here gives
    the rows that two left joins on the same key would, with one join of the large fact, not four.
    """
    if dedupe_tags:
        struct = F.struct("store_id", "brand_id", "channel", "locationid")
        tagging = tagging.groupBy("mtid").agg(F.min(struct).alias("_tag")).select("mtid", "_tag.*")
    tags = tagging.select(F.col("mtid").alias("_tag_mtid"), *TAGGING)
    tags = left_enrich(tags, taxonomy.select("store_id", "brand_id", *TAXONOMY),
                       ["store_id", "brand_id"], spread_by=["_tag_mtid"])
    places = location.select("locationid", *[F.col(c).alias(n) for c, n in LOCATION.items()])
    tags = left_enrich(tags, places, ["locationid"], spread_by=["_tag_mtid"]) \
        .withColumnRenamed("channel", "transaction_channel")
    shops = merchant.where(F.col("mtid").isNotNull()) \
        .select("mtid", *[F.col(c).alias(n) for c, n in MERCHANT.items()])
    tags = tags.where(F.col("_tag_mtid").isNotNull())
    both = shops.join(tags, shops["mtid"] == tags["_tag_mtid"], "full")
    return both.withColumn("_terminal", F.coalesce("mtid", "_tag_mtid")).drop("_tag_mtid")


def card_dimension(card: DataFrame, control: DataFrame | None, exposed: DataFrame | None,
                   id_col: str = "individual_id") -> DataFrame:
    """Card attributes, the owner's id and the owner's experiment group, keyed by card."""
    lists = [(label, ids) for label, ids in (("CONTROL", control), ("EXPOSED", exposed))
             if ids is not None]
    cards = card.where(F.col("membccid").isNotNull()) \
        .select("membccid", id_col, "card_type", "card_zip", "areaid")
    # many cards have no known owner: spread those NULL ids
    return label_membership(cards, id_col, lists, "experiment_group", spread_by=["membccid"])


def enrich_transactions(tx: DataFrame, card: DataFrame, merchant: DataFrame, tagging: DataFrame,
                        taxonomy: DataFrame, location: DataFrame,
                        control: DataFrame | None = None, exposed: DataFrame | None = None,
                        start=None, end=None, since=None, id_col: str = "individual_id",
                        dedupe_tags: bool = False, salt_from: int | None = None) -> DataFrame:
    """Transactions with card, merchant, brand, location and experiment attributes (35 columns).

    Run modes: ``start``/``end`` (inclusive back-fill), ``since`` (rows after a date: incremental),
    neither (full).  One terminal may carry several brand tags; each gives a row unless
    ``dedupe_tags`` keeps the lowest.  ``salt_from`` finds cards and terminals with at least that many
    rows and deals those rows out to many tasks; without it AQE's skew-join splitting does so at run
    time.  Nothing is computed while the plan is built, and whether the terminal dimension is
    broadcast is Spark's choice by its measured size.
    """
    rows = tx.where(F.col("trans_date").isNotNull())
    if start is not None and end is not None:
        rows = rows.where(F.col("trans_date").between(F.lit(start).cast("date"),
                                                      F.lit(end).cast("date")))
    elif since is not None:
        rows = rows.where(F.col("trans_date") > F.lit(since).cast("date"))
    rows = rows.select("txid", "trans_date", "trans_time", "trans_time_zone", "trans_amount",
                       F.col("delivery_date").alias("transaction_delivery_date"),
                       "membccid", F.col("mtid").alias("_terminal"))
    cards = terms = None
    if salt_from is not None:
        cards, terms = (large_groups(rows.where(F.col(k).isNotNull()), [k], salt_from) for k in ("membccid", "_terminal"))
    spread = ["txid", "trans_time"]
    out = left_enrich(rows, card_dimension(card, control, exposed, id_col), ["membccid"], spread,
                      cards)
    terminals = terminal_dimension(merchant, tagging, taxonomy, location, dedupe_tags)
    out = left_enrich(out, terminals, ["_terminal"], spread, terms)
    return out.select(
        "txid", "trans_date", "trans_time", "trans_time_zone", "trans_amount",
        "transaction_delivery_date", id_col, "membccid", "card_type", "card_zip", "areaid",
        "mtid", *MERCHANT.values(), *TAGGING.values(), *TAXONOMY, *LOCATION.values(),
        "experiment_group")
