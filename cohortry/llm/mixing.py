"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks of words.

A block is ``block`` words.  Seats go to the source with the highest quotient target / (2 k + 1), k being
the seats it has.  The rule is house-monotone: more seats in all never take one from a source.  So the
quota of shard j is what the apportionment of all blocks up to shard j gives beyond that of the shards
before it, an integer that is never negative, and every shard holds the target shares.  Within a source a
seeded order of the documents lays their words out as one stream; its blocks are taken in that order,
around the stream again where the quota exceeds the source.  :func:`mix` takes the words of all shards together.

Only DataFrame functions are used.  Windows run over sources, or over one of ``SLICES`` hash slices of a
source, never over all documents of one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortry.operators import materialise

from .common import lookup_join, word_count

BLOCK = 64
SHARDS = 8
CAP = 3
SEED = "mix-1"
SLICES = 3  # hex digits of the seeded hash that name the slice: 4,096 slices


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, weight, target`` from ``source, size``.

    Sources in code point order, NULL last, weigh 1, 2, 3, repeating; they share the total of all sizes.
    A target stops at three times the source's size and the excess is shared again by weight, which ends
    where all targets are weight x level or the cap: the level is found from the running sums in order of
    cap / weight.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    caps = per.withColumn("weight", ((F.row_number().over(order) - 1) % 3 + 1).cast("long")).withColumn(
        "cap", CAP * F.col("source_size"))
    by = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    running = caps.withColumn("total", F.sum("source_size").over(every)).withColumn(
        "weights", F.sum("weight").over(every)).withColumn(
        "capped", F.coalesce(F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).withColumn("used", F.coalesce(F.sum("weight").over(by.rowsBetween(Window.unboundedPreceding, -1)),
                                    F.lit(0)))
    level = running.withColumn("level", (F.col("total") - F.col("capped")).cast("double")
                               / (F.col("weights") - F.col("used")).cast("double"))
    # the first source, in this order, that its share does not fill
    free = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    chosen = level.withColumn("level", F.min(F.struct(
        F.when(free.isNotNull(), F.col("used")).otherwise(F.col("weights")).alias("u"), free.alias("v"))
    ).over(every)["v"])
    target = F.least(F.col("level") * F.col("weight"), F.col("cap").cast("double"))
    return chosen.select("source", "source_size", "weight",
                         F.coalesce(target, F.lit(0.0)).alias("target"))


def quotas(targets: DataFrame, block: int = BLOCK, shards: int = SHARDS) -> DataFrame:
    """``shard, source, seats``: blocks of each source in each shard, by Sainte-Lague."""
    every = Window.partitionBy()
    total = targets.withColumn("total", F.sum("target").over(every)).withColumn(
        "seats_all", F.floor(F.col("total") / block + 0.5))
    houses = total.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn(
        "house", F.expr(f"seats_all * (shard + 1) div {shards}"))
    # a source has target / d seats, rounded, for a common divisor d; as n sources round by half a seat at most, d lies
    # between total / (house + n / 2) and total / (house - n / 2).  What the greatest d gives, less one seat for ties,
    # is surely won, and what the least gives, plus one, is not exceeded; the seats between, four a source on
    # average, are ranked by quotient
    def bound(sources):
        return F.floor(F.when(F.col("total") > 0, F.col("target") * (F.col("house") + sources / 2) / F.col("total"))
                       .otherwise(0.0) + 0.5).cast("long")
    houses = houses.withColumn("sources", F.sum(F.when(F.col("target") > 0, 1).otherwise(0)).over(
        Window.partitionBy("shard")))
    sure = houses.withColumn("sure", F.greatest(bound(-F.col("sources")) - 1, F.lit(0))).withColumn(
        "most", bound(F.col("sources")) + 1)
    sure = sure.withColumn("left", F.col("house") - F.sum("sure").over(Window.partitionBy("shard")))
    seats = sure.withColumn("k", F.explode(F.sequence(F.col("sure"), F.col("most"))))
    ranked = seats.withColumn("rank", F.row_number().over(Window.partitionBy("shard").orderBy(
        (F.col("target") / (2 * F.col("k") + 1)).desc(), F.col("source").asc_nulls_last())))
    upto = ranked.groupBy("shard", "source").agg(
        (F.first("sure") + F.sum(F.when((F.col("rank") <= F.col("left")) & (F.col("target") > 0), 1)
                                 .otherwise(0))).alias("upto"))
    before = F.lag("upto", 1, 0).over(Window.partitionBy("source").orderBy("shard"))
    return upto.select("shard", "source", (F.col("upto") - before).alias("seats"))


def mix(docs: DataFrame, block: int = BLOCK, shards: int = SHARDS, seed: str = SEED,
        broadcast_rows: int = 200_000) -> DataFrame:
    """``docs`` (``doc_id, source, size`` and any others) with ``source_size``, ``target``, ``passes``
    (how often the whole stream is taken), ``begin`` (of the document in its source's stream), ``rest``
    (words taken of a last pass, from the stream's start) and ``taken``.

    A document is taken at most three times.  Equal rows follow one another in the stream; NULL sources
    are one source, the last; documents without words, or NULL ids, are placed like others.  Reruns agree:
    the order depends on the rows and the seed alone.
    """
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    laid = docs.withColumn("_h", key).withColumn("_slice", F.substring("_h", 1, SLICES))
    inner = Window.partitionBy("source", "_slice").orderBy(
        "_h", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, 0)
    slices = docs.withColumn("_slice", F.substring(key, 1, SLICES)).groupBy("source", "_slice").agg(
        F.sum("size").alias("n"))
    offset = F.sum("n").over(Window.partitionBy("source").orderBy("_slice")
                             .rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    starts = slices.select("source", "_slice", offset.alias("_offset"))
    targets = source_targets(docs.select("source", "size"))
    seats = quotas(targets, block, shards).groupBy(
        F.col("source").alias("_ks")).agg(F.sum("seats").alias("seats"))
    plan = materialise(targets.join(seats, F.col("source").eqNullSafe(F.col("_ks"))).select(
        "source", "source_size", "target",
        F.least(F.col("seats") * block, CAP * F.col("source_size")).alias("_words")))
    placed = laid.withColumn("_upto", F.sum("size").over(inner))
    placed = placed.join(starts.withColumnsRenamed({"source": "_ks", "_slice": "_kl"}),
                         F.col("source").eqNullSafe(F.col("_ks")) & (F.col("_slice") == F.col("_kl"))
                         ).drop("_ks", "_kl")
    full = lookup_join(placed, plan, ["source"], broadcast_rows)
    whole = F.when(F.col("source_size") > 0, F.expr("_words div source_size")).otherwise(F.lit(0))
    return (full.withColumn("passes", whole)
            .withColumn("rest", F.col("_words") - F.col("passes") * F.col("source_size"))
            .withColumn("begin", F.col("_offset") + F.col("_upto") - F.col("size"))
            .withColumn("taken", F.col("passes") * F.col("size") + F.greatest(
                F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("begin"))))
            .drop("_h", "_slice", "_upto", "_offset", "_words"))


def op10(docs: DataFrame) -> DataFrame:
    """Words taken of each document, in the columns of the contract."""
    sized = materialise(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    return mix(sized).select("doc_id", "size", "source_size", "target", F.col("taken").cast("long"))


def stage(docs: DataFrame) -> DataFrame:
    """Every document as often as the mix takes it: once per whole pass, and once more if the last pass
    reaches its first word.  Documents are not cut."""
    sized = docs.select(F.struct("*").alias("_row"), "doc_id", "source",
                        word_count(F.col("text")).alias("size"))
    again = F.when(F.col("begin") < F.col("rest"), 1).otherwise(0)
    copies = mix(sized).withColumn("_times", (F.col("passes") + again).cast("int"))
    return copies.where("_times > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_row.*")


def sql(source: str = "documents") -> str:
    """The same mix for DuckDB over ``source``; ends with ``mixed`` (``doc``, its row)."""
    return f"""
WITH sized AS (
  SELECT d AS doc, d.doc_id AS doc_id, d.source AS source,
         len(regexp_extract_all(coalesce(d.text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('{SEED}:' || coalesce(d.doc_id::VARCHAR, '')) AS h
  FROM {source} d),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
caps AS (
  SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight,
         {CAP} * source_size AS cap FROM per),
running AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         coalesce(sum(cap) OVER o, 0) AS capped, coalesce(sum(weight) OVER o, 0) AS used
  FROM caps
  WINDOW o AS (ORDER BY cap / weight, source ASC NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT *, (total - capped)::DOUBLE / (weights - used)::DOUBLE AS level FROM running),
targets AS (
  SELECT source, source_size, coalesce(least(arg_min(level, used) FILTER (level * weight <= cap) OVER ()
         * weight, cap::DOUBLE), 0.0) AS target FROM levels),
houses AS (
  SELECT *, sum(target) OVER () AS total FROM targets),
house AS (SELECT *, floor(total / {BLOCK} + 0.5)::BIGINT AS seats FROM houses),
bounds AS (
  SELECT *, count(*) FILTER (target > 0) OVER () AS n FROM house),
sure AS (
  SELECT *, greatest(floor(CASE WHEN total > 0 THEN target * (seats - n / 2) / total ELSE 0 END + 0.5)::BIGINT - 1, 0) AS sure,
         floor(CASE WHEN total > 0 THEN target * (seats + n / 2) / total ELSE 0 END + 0.5)::BIGINT + 1 AS most FROM bounds),
open AS (SELECT *, seats - sum(sure) OVER () AS open FROM sure),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source ASC NULLS LAST) AS rank
  FROM open, unnest(generate_series(sure, most)) AS s(k)),
plan AS (
  SELECT source, source_size, target, least((max(sure) + count(*) FILTER (rank <= open AND target > 0))
         * {BLOCK}, {CAP} * source_size)::BIGINT AS words
  FROM ranked GROUP BY source, source_size, target),
placed AS (
  SELECT z.*, source_size, target, words, sum(size) OVER (
           PARTITION BY z.source ORDER BY h, z.doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING)
           - size AS start
  FROM sized z JOIN plan p ON z.source IS NOT DISTINCT FROM p.source),
passes AS (
  SELECT *, CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS passes FROM placed),
mixed AS (
  SELECT *, words - passes * source_size AS rest,
         (passes * size + greatest(0, least(size, words - passes * source_size - start)))::BIGINT AS taken
  FROM passes)"""


SQL = sql() + "\nSELECT doc_id, size, source_size, target, taken FROM mixed"
