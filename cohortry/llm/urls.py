"""Filtering of URLs by rules and, where no rule fits, by two character models.

URLs that a rule allows or blocks teach two Markov models of variable order, one of accepted and one of
rejected URLs.  The chance of a character is taken from the longest context seen and smoothed with those of
the shorter ones, each weighing as much as it has seen different characters (Witten-Bell), down to an even
chance of 1 in 256.  A URL scores the difference of its log-likelihoods, divided by its length.  A fifth of the
decided URLs teaches no model; its scores calibrate the cut, so that accepted and rejected ones err least.

Counts are tables of character sequences and grow with the URLs; nothing of them is collected, nor broadcast: the
files they are read from are a small part of the rows made of them, and Spark judges by the files.  Differences
are whole numbers of 2^-20, so that sums do not depend on the order of rows.  Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.operators import materialise

#: verdict, host, path
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
ORDER = 5
EVEN = 1 / 256
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
START, END = "\x01", "\x02"
FINE = 1 << 20
#: Scores are cut at whole thousandths; beyond 50 nothing can lie but by rounding (8 bits a character and level).
BINS, MOST = 1000, 50_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://``, A to Z lower-cased, and path; both empty for NULL or without ``://``."""
    given = F.coalesce(url, F.lit(""))
    at = F.instr(given, "://")
    rest = F.when(at > 0, F.substring(given, at + 3, F.length(given))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct of ``rule`` and ``verdict`` of the longest rule that fits, NULL if none does.

    Of rules of equal length the one of the longer host wins, then the first.  Rules are a short list.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def sequences(df: DataFrame, text: Column, order: int = ORDER) -> DataFrame:
    """``df`` with a row and ``gram`` for each character of ``text`` and its end, after the ``order`` characters
    before it."""
    split = df.withColumn("_chars", F.split(F.concat(F.lit(START * order), text, F.lit(END)), ""))
    at = F.sequence(F.lit(0), F.size("_chars") - order - 1)
    return split.withColumn("gram", F.explode(F.transform(at, lambda i: F.concat(
        *[F.get("_chars", i + k) for k in range(order + 1)])))).drop("_chars")


def log_ratios(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, ratio`` for each row of ``counts`` (``gram, yes, no``: how often each class has it): the
    difference of the logarithms of the smoothed chances of its last character, in 2^-20.

    One level per length of context.  A window or join key meets at most as many rows as there are characters.
    """
    below = None
    for k in range(order + 1):
        level = counts.groupBy(F.substring("gram", order + 1 - k, k + 1).alias("gram")).agg(
            F.sum("yes").alias("yes"), F.sum("no").alias("no"))
        same = Window.partitionBy(F.substring("gram", 1, k))
        level = level.select("gram", *[x.cast("double").alias(name) for c in ("yes", "no") for name, x in (
            (c, F.col(c)), (f"{c}_n", F.sum(c).over(same)), (f"{c}_t", F.count(F.when(F.col(c) > 0, 1)).over(same)))])
        if below is None:
            level = level.withColumns({"yes_p": F.lit(EVEN), "no_p": F.lit(EVEN)})
        else:
            level = level.join(below.hint("merge"), F.substring("gram", 2, k) == F.col("_suffix"))
        below = level.select(F.col("gram").alias("_suffix"), *[F.when(
            F.col(f"{c}_n") > 0, (F.col(c) + F.col(f"{c}_t") * F.col(f"{c}_p")) / (F.col(f"{c}_n") + F.col(f"{c}_t"))
        ).otherwise(F.col(f"{c}_p")).alias(f"{c}_p") for c in ("yes", "no")])
    ratio = F.floor((F.log("yes_p") - F.log("no_p")) * FINE + 0.5)
    return below.select(F.col("_suffix").alias("gram"), ratio.cast("long").alias("ratio"))


def cut(scored: DataFrame) -> DataFrame:
    """One row, ``cut``: the bin from which on URLs are accepted, from rows of ``bin`` and ``accepted``.

    Both classes weigh the same.  All cuts between two neighbouring bins are equally good; of the best ones the
    one next to 0 is taken, then the lesser; without rows of both classes it is 0.  Bins are a bounded number of
    whole thousandths.
    """
    bins = scored.groupBy("bin").agg(F.count(F.when(F.col("accepted"), 1)).alias("yes"),
                                     F.count(F.when(~F.col("accepted"), 1)).alias("no"))
    order = Window.orderBy("bin")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    nearest = F.least("bin", F.lit(0))
    nearest = F.greatest(F.lag("bin").over(order) + 1, nearest)  # without a bin before it, the second
    everything = Window.partitionBy()
    rated = bins.select(
        nearest.alias("bin"), F.sum("yes").over(everything).alias("all_yes"), F.sum("no").over(everything).alias("all_no"),
        F.coalesce(F.sum("yes").over(before), F.lit(0)).alias("lost"),
        F.coalesce(F.sum("no").over(before), F.lit(0)).alias("caught"))
    wide = "decimal(19,0)"
    errors = (F.col("lost").cast(wide) * F.col("all_no") + (F.col("all_no") - F.col("caught")).cast(wide) * F.col("all_yes"))
    return rated.where("all_yes > 0 AND all_no > 0").agg(F.coalesce(F.min(F.struct(
        errors.alias("e"), F.abs("bin").alias("far"), "bin"))["bin"], F.lit(0).cast("long")).alias("cut"))


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
                keep: list[str] | None = None, order: int = ORDER) -> DataFrame:
    """``row`` (a struct of the columns in ``keep``, all by default), ``host, path, rule, verdict`` and ``margin``
    (thousandths above the cut; NULL where a rule decides) of every row of ``pages``.

    NULL urls and urls without ``://`` have an empty host and path, fit no rule and are judged as empty text.
    Repeated urls count as often as they stand and get the same verdict.  An empty table gives no rows.
    Without decided urls all scores are 0 and everything else is allowed.  Whole urls count, at any length.
    """
    host, path = host_and_path(F.col("url"))
    base = pages.select(F.struct(*[F.col(f"`{c}`") for c in keep or pages.columns]).alias("row"),
                        host.alias("host"), path.alias("path"))
    text = F.concat("host", "path")
    base = materialise(base.withColumn("found", fitting_rule(F.col("host"), F.col("path"), rules)).select(
        "row", "host", "path", F.col("found.rule").alias("rule"), (F.col("found.verdict") == "allow").alias("accepted"),
        (F.md5(text) < "33").alias("held"), F.monotonically_increasing_id().alias("rid")))
    taught = F.col("accepted").isNotNull() & ~F.col("held")
    counts = materialise(sequences(base.select("host", "path", F.when(taught, F.col("accepted")).alias("y")), text, order)
                         .groupBy("gram").agg(F.count(F.when(F.col("y"), 1)).alias("yes"),
                                              F.count(F.when(~F.col("y"), 1)).alias("no")))
    # hot sequences, such as the start of every URL, meet many rows: a plain join, which Spark can split
    scored = materialise(
        sequences(base.where(~taught).select("rid", "accepted", "host", "path"), text, order)
        .join(log_ratios(counts, order).hint("merge"), "gram").groupBy("rid", "accepted").agg(
            F.sum("ratio").alias("ratio"), F.count("*").alias("n")).select("rid", "accepted", F.greatest(
                F.lit(-MOST), F.least(F.lit(MOST), F.floor(F.col("ratio") / F.col("n") / FINE * BINS)))
            .cast("long").alias("bin")))
    limit = cut(scored.where("accepted IS NOT NULL"))
    judged = scored.where("accepted IS NULL").crossJoin(limit).select(  # one row
        F.col("rid").alias("_rid"), (F.col("bin") - F.col("cut")).alias("margin"))
    return base.join(judged.hint("merge"), F.col("rid") == F.col("_rid"), "left").select(
        "row", "host", "path", "rule",
        F.when(F.coalesce("accepted", F.col("margin") >= 0), "allow").otherwise("block").alias("verdict"), "margin")


def op13(pages: DataFrame) -> DataFrame:
    return filter_urls(pages, keep=["page_id"]).select("row.page_id", "host", "path", "rule", "verdict", "margin")


def _chance(c: str) -> str:
    return (f"CASE WHEN {c}_n > 0 THEN ({c} + {c}_t * b.{c}_p) / ({c}_n + {c}_t) ELSE b.{c}_p END AS {c}_p")


def _level(k: int) -> str:
    below = f"level{k - 1} b ON b.gram = substr(a.gram, 2, {k})" if k else f"(SELECT {EVEN}::DOUBLE AS yes_p, {EVEN}::DOUBLE AS no_p) b ON true"
    return f"""
level{k} AS (
  SELECT a.gram, {_chance('yes')}, {_chance('no')}
  FROM (SELECT gram, yes::DOUBLE AS yes, no::DOUBLE AS no,
               {', '.join(f"(sum({c}) OVER w)::DOUBLE AS {c}_n, (count(*) FILTER ({c} > 0) OVER w)::DOUBLE AS {c}_t" for c in ('yes', 'no'))}
        FROM (SELECT substr(gram, {ORDER + 1 - k}, {k + 1}) AS gram, sum(yes) AS yes, sum(no) AS no
              FROM counts GROUP BY 1)
        WINDOW w AS (PARTITION BY substr(gram, 1, {k}))) a JOIN {below})"""


_RULE = "CASE " + " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{'rule': '{h}{p}', 'verdict': '{v}'}}"
    for v, h, p in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))) + " END"

SQL = f"""
WITH rest AS (
  SELECT page_id, row_number() OVER () AS rid,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, rid, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
base AS (
  SELECT page_id, rid, host, path, found.rule AS rule, found.verdict = 'allow' AS accepted, md5(host || path) < '33' AS held,
         repeat(chr(1), {ORDER}) || host || path || chr(2) AS padded
  FROM (SELECT *, {_RULE} AS found FROM parts)),
grams AS (
  SELECT rid, accepted, held, substr(padded, i, {ORDER + 1}) AS gram
  FROM base, unnest(range(1, length(padded) - {ORDER} + 1)) AS t(i)),
counts AS (
  SELECT gram, count(*) FILTER (accepted AND NOT held) AS yes, count(*) FILTER (NOT accepted AND NOT held) AS no
  FROM grams GROUP BY gram),{','.join(_level(k) for k in range(ORDER + 1))},
ratios AS (SELECT gram, floor((ln(yes_p) - ln(no_p)) * {FINE} + 0.5)::BIGINT AS ratio FROM level{ORDER}),
scored AS (
  SELECT rid, accepted, greatest(-{MOST}, least({MOST}, floor(sum(ratio)::DOUBLE / count(*)::DOUBLE / {FINE} * {BINS})))::BIGINT AS bin
  FROM grams JOIN ratios USING (gram) WHERE accepted IS NULL OR held GROUP BY rid, accepted),
rated AS (
  SELECT any_value(coalesce(greatest(c.prev + 1, least(c.bin, 0)), least(c.bin, 0))) AS cut, (SELECT count(*) FROM scored WHERE accepted) AS all_yes,
         (SELECT count(*) FROM scored WHERE NOT accepted) AS all_no,
         count(*) FILTER (s.accepted AND s.bin < c.bin) AS lost, count(*) FILTER (NOT s.accepted AND s.bin >= c.bin) AS passed
  FROM (SELECT bin, lag(bin) OVER (ORDER BY bin) AS prev FROM scored WHERE accepted IS NOT NULL GROUP BY bin) c CROSS JOIN scored s
  WHERE s.accepted IS NOT NULL GROUP BY c.bin),
best AS (
  SELECT coalesce(arg_min(cut, [lost * all_no + passed * all_yes, abs(cut), cut]), 0) AS cut
  FROM rated WHERE all_yes > 0 AND all_no > 0)
SELECT page_id, host, path, rule,
       CASE WHEN coalesce(b.accepted, bin >= cut) THEN 'allow' ELSE 'block' END AS verdict,
       CASE WHEN b.accepted IS NULL THEN bin - cut END AS margin
FROM base b LEFT JOIN scored USING (rid) CROSS JOIN best"""
