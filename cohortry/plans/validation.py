"""Holdout validation of audiences: reach, shop and spend rates, and lift over everybody."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.functions import in_range, keyword_match, ratio
from cohortry.operators import (latest_version, materialise, prune_months, top_n)

NAME_COLUMNS = ("brand_name", "store_name", "merchant_description")


@dataclass(frozen=True)
class Audience:
    audience_id: str
    name: str
    brand_keywords: tuple[str, ...]
    date_start: date
    date_end: date

    @property
    def fault(self) -> str | None:
        """Why the definition cannot be measured, if so."""
        if self.date_start is None or self.date_end is None:
            return "a date is missing"
        if self.date_start >= self.date_end:
            return "the window is empty"
        return None if any(self.brand_keywords) else "there are no keywords"

    @property
    def measure(self):
        return self.date_start, self.date_end, tuple(sorted({k.upper()
                                                             for k in self.brand_keywords}))


def audiences_from(config: DataFrame) -> list[Audience]:
    """Audience definitions out of a config table (a hand-kept list, one row per audience)."""
    return [Audience(r["audience_id"], r["name"], tuple(r["brand_keywords"] or ()),
                     r["date_start"], r["date_end"])
            for r in config.orderBy("audience_id", "name").collect()]


def name_hits(names: DataFrame, keywords: DataFrame, gram: int = 3) -> DataFrame:
    """Pairs ``name, set_no`` for every name that holds a keyword of the set, from distinct upper-case ``name``
    and upper-case ``set_no, keyword``.

    An inverted index of the names' character sequences, of ``gram`` characters or as many as the shortest
    keywords have.  A keyword is looked up by the rarest of its sequences alone and then compared as a whole; one
    with a sequence that no name has needs no look.  Names are not tried against each keyword.
    """
    def sequences(text, size):
        last = F.length(text) - size + 1
        return F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
                                            lambda i: F.substring(text, i, size)))
    wanted = keywords.select("keyword").distinct().withColumn("size", F.least(F.length("keyword"), F.lit(gram)))
    parts = wanted.select("keyword", "size", F.explode(F.array_distinct(sequences(F.col("keyword"), F.col("size"))))
                          .alias("gram"))
    sizes = sorted(r["size"] for r in wanted.select("size").distinct().collect())  # gram + 1 at most
    index = names.select("name", F.explode(F.array_distinct(F.flatten(F.array_compact(F.array(*[
        sequences(F.col("name"), F.lit(k)) for k in sizes]))))).alias("gram"))
    rarity = index.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = parts.join(rarity, "gram", "left").groupBy("keyword").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("r")).where("r.n > 0")
    found = index.join(rarest.select("keyword", F.col("r.gram").alias("gram")), "gram").where(
        F.col("name").contains(F.col("keyword"))).select("name", "keyword")
    return found.join(keywords, "keyword").select("name", "set_no").distinct()


def measured_rows(fact: DataFrame, start: date, end: date, id_col: str = "individual_id",
                  name_cols: Sequence[str] = NAME_COLUMNS) -> DataFrame:
    """Stored totals per person, day and names within ``[start, end)``: the one scan of the fact."""
    rows = prune_months(fact, start, end).where(in_range("trans_date", start, end))
    return materialise(rows.groupBy(id_col, "trans_date", *name_cols).agg(
        F.count(F.lit(1)).alias("_rows"), F.count("txid").alias("_tx"), F.sum("trans_amount").alias("_spend")))


def activity(rows: DataFrame, windows: DataFrame, id_col: str = "individual_id") -> DataFrame:
    """People with an id and the windows ``window_no, start, end`` in which they have a row."""
    days = windows.where("start < end").select(
        "window_no", F.explode(F.sequence("start", F.date_sub("end", 1))).alias("trans_date"))
    seen = rows.where(F.col(id_col).isNotNull()).select(id_col, F.col("trans_date").cast("date")).distinct()
    return seen.join(days, "trans_date").select(id_col, "window_no").distinct()


def brand_totals(rows: DataFrame, keywords: DataFrame, measures: DataFrame, id_col: str = "individual_id",
                 name_cols: Sequence[str] = NAME_COLUMNS) -> DataFrame:
    """Rows, transactions and spend per person and measure ``measure_no, set_no, start, end``.  People without
    an id are one NULL row of each measure.

    Names are matched once each; transactions meet only the measures whose keywords their names hold.
    """
    names = rows.select(*name_cols).distinct()
    each = names.select("*", F.explode(F.array_distinct(F.array_compact(F.array(*[F.upper(c) for c in name_cols])))
                                       ).alias("name"))
    hits = name_hits(each.select("name").distinct(), keywords)
    sets = each.join(hits, "name").select(*[F.col(c).alias(f"_h_{c}") for c in name_cols], "set_no").distinct()
    alike = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_h_{c}")) for c in name_cols])
    hit = rows.join(sets, alike).join(measures, "set_no").where(
        (F.col("trans_date") >= F.col("start")) & (F.col("trans_date") < F.col("end")))
    return hit.groupBy(id_col, "measure_no").agg(F.sum("_rows").alias("_rows"), F.sum("_tx").alias("_tx"),
                                                 F.sum("_spend").alias("_spend"))


def person_measures(fact: DataFrame, measures: Sequence[tuple], id_col: str = "individual_id",
                    name_cols: Sequence[str] = NAME_COLUMNS) -> tuple[DataFrame, dict]:
    """Per person and (window, keywords) of a few measures, as columns: activity, brand rows, transactions and
    spend.

    One scan and one combinable aggregate.  People without an id stay as one NULL row, since their spend
    counts in the baseline.
    """
    windows = sorted({(s, e) for s, e, _ in measures})
    inside = {w: in_range("trans_date", *w) for w in windows}
    fact = prune_months(fact, min(s for s, _ in windows), max(e for _, e in windows))
    rows = fact.where(reduce(lambda a, b: a | b, inside.values()))
    aggs = [F.count_if(inside[w]).alias(f"_act{i}") for i, w in enumerate(windows)]
    for j, (start, end, keywords) in enumerate(measures):
        hit = inside[start, end] & F.col(f"_hit{j}")
        aggs += [F.count_if(hit).alias(f"_rows{j}"),
                 F.count(F.when(hit, F.col("txid"))).alias(f"_tx{j}"),
                 F.sum(F.when(hit, F.col("trans_amount"))).alias(f"_spend{j}")]
    # names are put in upper case once per row, whatever the number of keywords
    kept = [id_col, "trans_date", "txid", "trans_amount"]
    rows = rows.select(*kept, *[F.upper(c).alias(f"_u{i}") for i, c in enumerate(name_cols)])
    names = [f"_u{i}" for i in range(len(name_cols))]
    rows = rows.select(*kept, *[keyword_match(names, keywords, upper=False).alias(f"_hit{j}")
                                for j, (_, _, keywords) in enumerate(measures)])
    return rows.groupBy(id_col).agg(*aggs), {w: i for i, w in enumerate(windows)}


def add_rates(df: DataFrame) -> DataFrame:
    """Rates and lifts from the counts; audience rates are 0 without a base, lifts are NULL."""
    def rate(num, den):
        return F.coalesce(F.when(F.col(den) > 0, ratio(num, den)), F.lit(0.0))

    def lift(num, base_num):
        audience = ratio(num, "active_matched_ids")
        baseline = ratio(base_num, "baseline_active_ids")
        return F.when((F.col("baseline_active_ids") > 0) & (F.col(base_num) > 0),
                      F.try_divide(audience, baseline))
    return df.select(
        "*",
        rate("brand_shoppers", "active_matched_ids").alias("shop_rate"),
        rate("brand_spend", "active_matched_ids").alias("spend_rate"),
        rate("brand_spend", "brand_transactions").alias("average_ticket"),
        rate("brand_transactions", "brand_shoppers").alias("avg_transactions_per_shopper"),
        rate("baseline_brand_shoppers", "baseline_active_ids").alias("baseline_shop_rate"),
        rate("baseline_brand_spend", "baseline_active_ids").alias("baseline_spend_rate"),
        lift("brand_shoppers", "baseline_brand_shoppers").alias("shop_rate_lift"),
        lift("brand_spend", "baseline_brand_spend").alias("spend_rate_lift"))


RESULT_COLUMNS = [
    "audience_name", "audience_id", "total_lal_ids", "active_matched_ids", "brand_shoppers",
    "brand_transactions", "brand_spend", "shop_rate", "spend_rate", "average_ticket",
    "avg_transactions_per_shopper", "baseline_active_ids", "baseline_brand_shoppers",
    "baseline_shop_rate", "baseline_spend_rate", "shop_rate_lift", "spend_rate_lift"]

COUNT_COLUMNS = ["total_lal_ids", "active_matched_ids", "brand_shoppers", "brand_transactions", "brand_spend"]


def _baseline(people: DataFrame, measures, windows, id_col) -> tuple[dict, dict]:
    known = F.col(id_col).isNotNull()
    aggs = [F.count_if(known & (F.col(f"_act{i}") > 0)).alias(f"_act{i}")
            for i in windows.values()]
    for j in range(len(measures)):
        aggs += [F.count_if(known & (F.col(f"_rows{j}") > 0)).alias(f"_rows{j}"),
                 F.coalesce(F.sum(f"_spend{j}").cast("double"), F.lit(0.0)).alias(f"_spend{j}")]
    row = people.agg(*aggs).first()
    active = {w: row[f"_act{i}"] for w, i in windows.items()}
    brand = {m: (row[f"_rows{j}"], row[f"_spend{j}"]) for j, m in enumerate(measures)}
    return active, brand


def validate_audiences(spark: SparkSession, audiences: Iterable[Audience], lookup: DataFrame,
                       metadata: DataFrame, fact: DataFrame, id_col: str = "individual_id",
                       seed: DataFrame | None = None) -> DataFrame:
    """One row per audience definition, however many, from one scan of the fact.

    Definitions, windows and keywords are tables that are joined: a person has a row for each window it is
    active in and for each measure (window and keywords) it bought by, and a member meets those of its audience.

    A definition that cannot be measured (a date or all keywords missing, or dates in the wrong order)
    keeps its row with the reason in ``error`` and NULL metrics; the others are measured.

    Members are the distinct ids of the audience's latest version.  An audience without members keeps
    its row with zero counts and NULL lifts.  With ``seed`` the result has one row per audience and
    ``is_seed`` value that occurs.
    """
    audiences = list(audiences)
    if not audiences:
        raise ValueError("no audiences defined")
    sound = [a for a in audiences if a.fault is None]
    faulty = spark.createDataFrame([(a.name, a.audience_id, a.fault) for a in audiences if a.fault],
                                   "audience_name string, audience_id string, error string")
    if not sound:
        return faulty
    windows, sets, measures = ({x: i for i, x in enumerate(dict.fromkeys(xs))} for xs in (
        ((a.date_start, a.date_end) for a in sound), (a.measure[2] for a in sound), (a.measure for a in sound)))
    defined = spark.createDataFrame(
        [(no, a.audience_id, a.name, windows[a.date_start, a.date_end], measures[a.measure]) for no, a in enumerate(sound)],
        "_no int, audience_id string, audience_name string, window_no int, measure_no int")
    window_table = spark.createDataFrame([(i, *w) for w, i in windows.items()], "window_no int, start date, end date")
    measure_table = spark.createDataFrame([(i, sets[k], start, end) for (start, end, k), i in measures.items()],
                                          "measure_no int, set_no int, start date, end date")
    keywords = spark.createDataFrame([(i, k) for ks, i in sets.items() for k in ks], "set_no int, keyword string")

    rows = measured_rows(fact, min(s for s, _ in windows), max(e for _, e in windows), id_col)
    active = materialise(activity(rows, window_table, id_col))
    brand = materialise(brand_totals(rows, keywords, measure_table, id_col))
    members = latest_version(lookup, metadata).where(F.col(id_col).isNotNull()) \
        .join(defined.select("audience_id").distinct(), "audience_id", "left_semi") \
        .select("audience_id", id_col).distinct()
    extra = []
    if seed is not None:
        flags = seed.select(id_col).distinct().withColumn("_seed", F.lit(1))
        members = members.join(flags, id_col, "left") \
            .select("audience_id", id_col, F.coalesce("_seed", F.lit(0)).alias("is_seed"))
        extra = ["is_seed"]
    met = members.join(defined, "audience_id").join(active.withColumn("_act", F.lit(1)), [id_col, "window_no"], "left") \
        .join(brand, [id_col, "measure_no"], "left")
    counts = met.groupBy("_no", *extra).agg(
        F.count(F.lit(1)).alias("total_lal_ids"), F.count("_act").alias("active_matched_ids"),
        F.count_if(F.col("_rows") > 0).alias("brand_shoppers"), F.sum("_tx").alias("brand_transactions"),
        F.sum("_spend").cast("double").alias("brand_spend"))
    everyone = active.groupBy("window_no").agg(F.count(F.lit(1)).alias("baseline_active_ids"))
    shoppers = brand.groupBy("measure_no").agg(
        F.count_if(F.col(id_col).isNotNull() & (F.col("_rows") > 0)).alias("baseline_brand_shoppers"),
        F.sum("_spend").cast("double").alias("baseline_brand_spend"))
    joined = defined.join(everyone, "window_no", "left").join(shoppers, "measure_no", "left") \
        .join(counts, "_no", "inner" if extra else "left")
    filled = joined.fillna(0, subset=[*COUNT_COLUMNS, "baseline_active_ids", "baseline_brand_shoppers",
                                      "baseline_brand_spend"])
    measured = add_rates(filled).select(*RESULT_COLUMNS, *extra, F.lit(None).cast("string").alias("error"))
    return measured.unionByName(faulty, allowMissingColumns=True)


def reach_curve(scores: DataFrame, fact: DataFrame, sizes: Sequence[int], keywords: Sequence[str],
                start: date, end: date, score: str = "similarity_score",
                id_col: str = "individual_id") -> DataFrame:
    """Holdout metrics of the top-n audience for several n, from one ranking and one fact scan."""
    sizes = sorted(set(sizes))
    best = top_n(scores.select(id_col, score), score, id_col, sizes[-1], rank="_rank")
    band = F.lit(len(sizes) - 1)  # index of the smallest size that holds the rank
    for i, size in reversed(list(enumerate(sizes))):
        band = F.when(F.col("_rank") <= size, i).otherwise(band)
    banded = best.select(id_col, band.alias("_band"))
    measure = (start, end, tuple(keywords))
    people, windows = person_measures(fact, [measure], id_col)
    people = materialise(people)
    active, brand = _baseline(people, [measure], windows, id_col)
    rows = banded.join(people, id_col, "left").groupBy("_band") \
        .agg(F.count(F.lit(1)).alias("_ids"),
             F.count_if(F.col("_act0") > 0).alias("_act"),
             F.count_if(F.col("_rows0") > 0).alias("_shop"),
             F.coalesce(F.sum("_tx0"), F.lit(0)).alias("_tx"),
             F.sum("_spend0").alias("_spend"))
    columns = {"total_lal_ids": "_ids", "active_matched_ids": "_act", "brand_shoppers": "_shop",
               "brand_transactions": "_tx", "brand_spend": "_spend"}
    sums = rows.agg(*[F.sum(F.when(F.col("_band") <= i, F.col(c))).alias(f"{n}{i}")
                      for i in range(len(sizes)) for n, c in columns.items()])
    curve = sums.select(F.inline(F.array(*[
        F.struct(F.lit(size).cast("bigint").alias("audience_size"),
                 *[F.coalesce(F.col(f"{n}{i}").cast("double" if n == "brand_spend" else "bigint"),
                              F.lit(0)).alias(n) for n in columns])
        for i, size in enumerate(sizes)])))
    shoppers, spend = brand[measure]
    return add_rates(curve.select(
        "*", F.lit(active[start, end]).cast("bigint").alias("baseline_active_ids"),
        F.lit(shoppers).cast("bigint").alias("baseline_brand_shoppers"),
        F.lit(spend).cast("double").alias("baseline_brand_spend"))).drop("baseline_brand_spend")


def run_delta(previous: DataFrame, current: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
    """Metric by metric comparison of two runs: absolute change and change in percent."""
    def long(df, name):
        pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias(name))
                          for m in metrics])
        return df.select(key, F.inline(pairs))
    both = long(previous, "previous").join(long(current, "current"), [key, "metric"], "full")
    change = F.col("current") - F.col("previous")
    return both.select(key, "metric", "previous", "current", change.alias("change"),
                       (ratio(change, "previous") * 100).alias("change_pct"))
