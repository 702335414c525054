"""Quality rules whose thresholds follow the data: one quantile sketch per language and source.

A sketch counts the values of a metric by their six leading bits: smaller values than 64 exactly, larger
ones to one part in 32.  Counts add up, so sketches merge exactly and in any order: those of the sources
of a language give the sketch of the language, and these the sketch of everything.  A source with fewer
than ``min_rows`` documents takes the thresholds of its language, a small language those of everything.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.operators import materialise

from .common import lookup_join, ngrams, words

#: Metric and the slack added to its fence, in thousandths: a group without spread still allows this much.
SLACK = {"symbols_pm": 100, "dup_lines_pm": 75, "repeats_pm": 200, "capitals_pm": 150}
SYMBOLS = r"[#*$%&|<>]"
METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def with_metrics(docs: DataFrame) -> DataFrame:
    """``docs`` and their counts: ``n_words``, ``word_chars`` (code points in words), ``n_symbols``,
    ``n_dup_lines`` (lines with a word that equal an earlier line), ``n_repeat_words`` (words in 5-word
    windows that the text has twice or more) and ``base_failed``, all in ``_q``; and the thousandths the
    sketches count in ``_m``.  NULL text counts as empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.withColumn("_w", words(F.col("text")))
    hashed = split.withColumn("_n", F.size("_w")).withColumn(
        "_wh", F.transform("_w", lambda w: F.xxhash64(w))).drop("_w")
    grams = hashed.withColumn("_g", ngrams(F.col("_wh"), F.col("_n"), 5)).drop("_wh")
    # the windows in order of their hash: equal ones are neighbours; nothing to sort if all differ
    ordered = grams.withColumn("_s", F.when(
        F.size(F.array_distinct("_g")) < F.size("_g"),
        F.sort_array(F.transform("_g", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))).drop("_g")
    twice = ordered.withColumn("_p", F.sort_array(F.transform(F.filter(
        "_s", lambda e, i: F.coalesce(F.get("_s", i + 1)["h"] == e["h"], F.lit(False))
        | F.coalesce(F.get("_s", F.greatest(i - 1, F.lit(-1)))["h"] == e["h"], F.lit(False))),
        lambda e: e["i"]))).drop("_s")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = twice.withColumn("_r", F.aggregate(
        F.transform("_p", lambda x, i: F.least(F.lit(5), F.coalesce(F.get("_p", i + 1) - x, F.lit(5)))),
        F.lit(0), lambda a, x: a + x)).drop("_p").withColumn("_l", lines)
    n, rep = F.col("_n").cast("long"), F.col("_r").cast("long")
    chars = F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long")
    q = counted.withColumn("_q", F.struct(
        n.alias("n_words"), chars.alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        rep.alias("n_repeat_words"), ((n < 10) | (100 * rep > 20 * n)).alias("base_failed"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals")))
    q = q.drop("_n", "_r", "_l")

    def pm(part: str, whole: str) -> Column:
        return F.expr(f"1000 * _q.{part} div greatest(_q.{whole}, 1L)")
    return q.withColumn("_m", F.struct(
        pm("n_symbols", "n_words").alias("symbols_pm"), pm("n_dup_lines", "n_words").alias("dup_lines_pm"),
        pm("n_repeat_words", "n_words").alias("repeats_pm"),
        pm("n_capitals", "word_chars").alias("capitals_pm")))


def sketch(measured: DataFrame) -> DataFrame:
    """Sketches of the documents that pass the base rules: ``lang, source, metric, bucket, n``."""
    entries = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"_m.{m}").alias("v")) for m in SLACK])
    long = measured.where(~F.col("_q.base_failed")).select("lang", "source", F.explode(entries).alias("e"))
    shift = "greatest(length(bin(e.v)) - 6, 0)"
    return long.groupBy("lang", "source", F.col("e.metric").alias("metric"),
                        F.expr(f"shiftleft(shiftright(e.v, {shift}), {shift})").alias("bucket")
                        ).agg(F.count("*").alias("n"))


def merge_sketches(sketches: DataFrame, by: list[str]) -> DataFrame:
    return sketches.groupBy(*by, "metric", "bucket").agg(F.sum("n").alias("n"))


def fences(sketches: DataFrame, by: list[str], spread: int) -> DataFrame:
    """One row per group: documents in ``n`` and a fence per metric, the upper quartile plus ``spread``
    times the quartile distance plus the slack."""
    group = Window.partitionBy(*by, "metric")
    ranked = sketches.withColumn("total", F.sum("n").over(group)).withColumn(
        "below", F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)))
    quart = ranked.groupBy(*by, "metric").agg(
        F.max("total").alias("total"),
        F.min(F.when(F.col("below") * 4 >= F.col("total"), F.col("bucket"))).alias("q1"),
        F.min(F.when(F.col("below") * 4 >= F.col("total") * 3, F.col("bucket"))).alias("q3"))
    def fence(m):
        return F.max(F.when(F.col("metric") == m, F.col("q3") + spread * (F.col("q3") - F.col("q1"))
                            + SLACK[m])).alias(m)
    return quart.groupBy(*by).agg(F.max("total").alias("n"), *[fence(m) for m in SLACK])


def thresholds(sketches: DataFrame, min_rows: int = 100, spread: int = 3) -> DataFrame:
    """``lang, source`` and a fence for each metric."""
    own = fences(sketches, ["lang", "source"], spread)
    lang = fences(merge_sketches(sketches, ["lang"]), ["lang"], spread)
    whole = fences(merge_sketches(sketches, []), [], spread)
    pick = [F.when(F.col("o.n") >= min_rows, F.col(f"o.{m}"))
            .when(F.col("l.n") >= min_rows, F.col(f"l.{m}")).otherwise(F.col(f"w.{m}")).alias(m)
            for m in SLACK]
    return (own.alias("o").join(lang.alias("l"), F.col("o.lang").eqNullSafe(F.col("l.lang")))
            .crossJoin(whole.alias("w"))  # one row
            .select("o.lang", "o.source", *pick))


def judge(measured: DataFrame, limits: DataFrame, broadcast_rows: int = 200_000) -> DataFrame:
    """``measured`` with ``kept``: passes the base rules and exceeds no fence of its language and source."""
    joined = lookup_join(measured, limits.select("lang", "source", F.struct(*SLACK).alias("_f")),
                         ["lang", "source"], broadcast_rows)
    inside = ~F.col("_q.base_failed")
    for m in SLACK:
        inside = inside & F.coalesce(F.col(f"_m.{m}") <= F.col(f"_f.{m}"), F.lit(True))
    return joined.withColumn("_kept", inside).drop("_f")


def quality_rules(docs: DataFrame, keep: list[str] | None = None, min_rows: int = 100) -> DataFrame:
    """``row`` (a struct of the columns in ``keep``, all by default), ``lang, source``, the counts ``_q``
    and ``_m`` and the verdict ``_kept`` of every row of ``docs``.

    NULL ``lang`` and ``source`` are groups of their own.  NULL or empty text has no words and fails.
    Rows are judged one by one: repeated rows get the same verdict, an empty table gives an empty one.
    Further columns, of any name, stay in ``row``.  The measured rows are stored once; sketches and
    verdicts read them back.
    """
    own = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns])
    measured = materialise(with_metrics(docs.select(own.alias("row"), "text", "lang", "source")).drop("text"))
    return judge(measured, materialise(thresholds(sketch(measured), min_rows)))


def op9(docs: DataFrame) -> DataFrame:
    """Counts and verdict per document, in the columns of the contract."""
    judged = quality_rules(docs, ["doc_id"])
    return judged.select("row.doc_id", *[F.col(f"_q.{m}").alias(m) for m in METRICS],
                         F.col("_kept").alias("kept"))


def stage(docs: DataFrame) -> DataFrame:
    """The documents the rules keep, in their own columns."""
    return quality_rules(docs).where("_kept").select("row.*")


def _fence_sql(name: str, by: str) -> str:
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {keys}metric"
    picks = ", ".join(f"max(CASE WHEN metric = '{m}' THEN q3 + 3 * (q3 - q1) + {s} END) AS {m}"
                      for m, s in SLACK.items())
    return f"""
{name}_ranked AS (
  SELECT {keys}metric, bucket, sum(n) AS n FROM sketch GROUP BY {keys}metric, bucket),
{name}_below AS (
  SELECT *, sum(n) OVER ({part}) AS total,
         sum(n) OVER ({part} ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS below FROM {name}_ranked),
{name}_quart AS (
  SELECT {keys}metric, max(total) AS total, min(bucket) FILTER (below * 4 >= total) AS q1,
         min(bucket) FILTER (below * 4 >= total * 3) AS q3 FROM {name}_below GROUP BY {keys}metric),
{name} AS (SELECT {keys}max(total) AS n, {picks} FROM {name}_quart {'GROUP BY ' + by if by else ''})"""


_ENTRIES = ", ".join(f"('{m}', {m})" for m in SLACK)
_PICKS = ", ".join(f"CASE WHEN o.n >= 100 THEN o.{m} WHEN l.n >= 100 THEN l.{m} ELSE w.{m} END AS {m}"
                   for m in SLACK)
_INSIDE = " AND ".join(f"coalesce(c.{m} <= f.{m}, true)" for m in SLACK)


def sql(source: str = "documents") -> str:
    """The same rules for DuckDB over ``source``; ends with the relation ``judged`` (``doc``, its row)."""
    return f"""
WITH numbered AS (SELECT row_number() OVER () AS rid, d AS doc, coalesce(d.text, '') AS t FROM {source} d),
split AS (
  SELECT rid, doc, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM numbered),
grams AS (
  SELECT rid, i, w[i:i + 4] AS g FROM split, unnest(generate_series(1, len(w) - 4)) AS s(i)),
twice AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM grams),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM twice, unnest(generate_series(0, 4)) AS s(k)
  WHERE c > 1 GROUP BY rid),
counts AS (
  SELECT s.rid, doc, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(t, '[^\\p{{Lu}}]', '', 'g'))::BIGINT AS n_capitals
  FROM split s LEFT JOIN covered c USING (rid)),
measured AS (
  SELECT *, doc.lang AS lang, doc.source AS source,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         1000 * n_symbols // greatest(n_words, 1) AS symbols_pm,
         1000 * n_dup_lines // greatest(n_words, 1) AS dup_lines_pm,
         1000 * n_repeat_words // greatest(n_words, 1) AS repeats_pm,
         1000 * n_capitals // greatest(word_chars, 1) AS capitals_pm
  FROM counts),
long AS (
  SELECT lang, source, unnest([{', '.join(repr(m) for m in SLACK)}]) AS metric,
         unnest([{', '.join(SLACK)}]) AS v
  FROM measured WHERE NOT base_failed),
sketch AS (
  SELECT lang, source, metric,
         CASE WHEN v < 64 THEN v ELSE (v >> (length(bin(v)) - 6)) << (length(bin(v)) - 6) END AS bucket,
         count(*) AS n
  FROM long GROUP BY ALL),{_fence_sql('own', 'lang, source')},{_fence_sql('by_lang', 'lang')},{_fence_sql('whole', '')},
limits AS (
  SELECT o.lang, o.source, {_PICKS}
  FROM own o JOIN by_lang l ON o.lang IS NOT DISTINCT FROM l.lang CROSS JOIN whole w),
judged AS (
  SELECT c.*, NOT base_failed AND {_INSIDE} AS kept
  FROM measured c LEFT JOIN limits f
    ON c.lang IS NOT DISTINCT FROM f.lang AND c.source IS NOT DISTINCT FROM f.source)"""


SQL = sql() + f"\nSELECT doc.doc_id AS doc_id, {', '.join(METRICS)}, kept FROM judged"
