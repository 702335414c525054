"""Benchmark decontamination: item-sized windows, SimHash fingerprints, exact check.

For an item of n words a window is n consecutive words of a document (fewer at its end).  Both become
multisets of five-word shingles; a window within similarity 0.8 of the item (shared over all, counted
with multiplicity) is a leak.

1. A window that matches may be taken to start at a shingle of an item of its size: moving the start to
   the first such shingle loses none of those it shares and adds no words.  So only those starts are kept.
2. Each window and item gets a 64-bit SimHash of its weighted shingles.
3. Fingerprints are cut into RADIUS + 1 blocks.  Two that differ in at most RADIUS bits agree in a whole
   block, so joining on (size, block, its bits) finds every pair within the radius.
4. Those pairs are compared exactly.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.operators import materialise

from .common import lookup_join, ngrams, small, words

SHINGLE = 5
#: At similarity 0.8 fingerprints differ in 9 bits on average, deviation 2.8: the radius is 4.5 of them off.
RADIUS = 22
PERCENT = 80


def shingled(df: DataFrame, text: str) -> DataFrame:
    """Adds ``_n`` words and ``_g``, the shingle hashes in order: one of the whole text if it is shorter,
    none without words."""
    hashed = df.withColumn("_wh", F.transform(words(F.lower(F.col(text))), lambda w: F.xxhash64(w)))
    sized = hashed.withColumn("_n", F.size("_wh"))
    whole = F.when(F.col("_n") > 0, F.array(F.xxhash64(F.lit("short"), F.col("_wh")))).otherwise(
        F.array().cast("array<bigint>"))
    return sized.withColumn("_g", F.when(F.col("_n") < SHINGLE, whole).otherwise(
        ngrams(F.col("_wh"), F.col("_n"), SHINGLE))).drop("_wh")


def _lane_simhash(grams: Column, bits: int) -> Column:
    """SimHash whose counts are kept side by side in one long, ``bits`` wide each; the top lane stays positive
    below 2^(bits - 1) shingles."""
    per, width = 64 // bits, (1 << bits) - 1
    step = 64 // per
    lanes = sum(1 << (step * k) for k in range(per))

    # one expression for all lanes, not one each: plans stay small
    sums = F.transform(F.sequence(F.lit(0), F.lit(step - 1)), lambda b: F.aggregate(
        grams, F.lit(0).cast("long"), lambda a, x: a + F.call_function("shiftrightunsigned", x, b).bitwiseAND(F.lit(lanes))))

    def bit(total, b, k):
        count = F.shiftrightunsigned(total, step * k).bitwiseAND(F.lit(width))
        return F.call_function("shiftleft", F.when(2 * count > F.size(grams), F.lit(1)).otherwise(
            F.lit(0)).cast("long"), b + step * k)

    def together(t, b):
        out = bit(t, b, 0)
        for k in range(1, per):
            out = out.bitwiseOR(bit(t, b, k))
        return out
    return F.aggregate(F.transform(sums, together), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def simhash(grams: Column) -> Column:
    """64-bit SimHash: bit b is set where more than half of the shingle hashes have it.  Counts of 16 bits
    hold up to 32,767 shingles, and are faster; longer texts are counted in 32 bits, with the same result."""
    return F.when(F.size(grams) < 1 << 15, _lane_simhash(grams, 16)).otherwise(_lane_simhash(grams, 32))


def blocks() -> list[tuple[int, int]]:
    """First bit and mask of each block; together they are the 64 bits."""
    edges = [64 * i // (RADIUS + 1) for i in range(RADIUS + 2)]
    return [(a, (1 << (b - a)) - 1) for a, b in zip(edges, edges[1:])]


def block_values(print_: Column) -> Column:
    return F.array(*[F.shiftrightunsigned(print_, a).bitwiseAND(F.lit(m)).cast("int")
                     for a, m in blocks()])


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def counted(grams: Column) -> Column:
    """The multiset as a set: the k-th copy of a shingle gets a hash of its own.  Equal ones are neighbours
    once sorted, so the work is that of sorting."""
    def copies(s, first):
        return F.flatten(F.transform(first, lambda p, j: F.transform(
            F.sequence(F.lit(0), F.coalesce(F.get(first, j + 1), F.size(s)) - p - 1),
            lambda k: F.xxhash64(F.get(s, p), k))))

    def firsts(s):
        return F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                        lambda i: (i == 0) | (F.get(s, F.greatest(i - 1, F.lit(0))) != F.get(s, i)))
    return F.when(F.size(grams) > 0, _let(F.sort_array(grams), lambda s: _let(firsts(s), lambda f: copies(s, f)))
                  ).otherwise(F.array().cast("array<bigint>"))


def with_keys(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_key, _key2``, two hashes of the text; NULL counts as empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("_key", F.xxhash64(F.lit(1), text)).withColumn(
        "_key2", F.xxhash64(F.lit(2), text))


def leaks(docs: DataFrame, benchmark: DataFrame, broadcast_rows: int = 1_000_000) -> DataFrame:
    """``_key`` (hash of the text), ``doc_id, item_id, start, similarity`` of every matching window.

    Texts are lower-cased and split at white space.  NULL and empty texts have no words and match
    nothing; an item under five words matches a document of just these words.  Repeated documents and
    items match one by one.  Tables of items and of starts are broadcast only when counted as small; beyond that
    no table is broadcast by the size of its files.  Many starts are dealt out with the texts that have some.
    """
    items = materialise(shingled(benchmark.select("item_id", "text"), "text").where("_n > 0").select(
        F.monotonically_increasing_id().alias("_item"), "item_id", F.col("_n").alias("m"), "_g",
        simhash(F.col("_g")).alias("_print"), counted(F.col("_g")).alias("_set")))
    few = small(items.select(F.explode("_g")), broadcast_rows)

    def maybe(df):
        return F.broadcast(df) if few else df.hint("merge")
    keyed = with_keys(docs.select("doc_id", "text"))
    grams = shingled(keyed, "text")
    # outer, as the plain form adds a filter that computes the shingles a second time; NULLs join nothing
    wanted = items.select(F.explode("_g").alias("_x"), "m").distinct()
    starts = materialise(grams.select("_key", "_key2", F.posexplode_outer("_g").alias("_at", "_x")).join(
        maybe(wanted), "_x").groupBy("_key", "_key2").agg(
            F.collect_set(F.struct("_at", "m")).alias("_starts")))
    texts, keys, each = keyed.select("doc_id", "text", "_key", "_key2"), ["_key", "_key2"], starts.select(F.explode("_starts"))
    if not small(each, broadcast_rows):
        texts = lookup_join(texts, starts.select(*keys, F.lit(True).alias("_hit")), keys, broadcast_rows).where(
            "_hit").drop("_hit")
    found = shingled(lookup_join(texts, starts, keys, broadcast_rows, whole=each).where("_starts is not null"), "text")
    windows = found.select("doc_id", "_key", "_key2", "_g", F.explode("_starts").alias("_s")).select(
        "doc_id", "_key", "_key2", F.col("_s._at").alias("start"), F.col("_s.m").alias("m"),
        F.slice("_g", F.col("_s._at") + 1, F.greatest(F.col("_s.m") - (SHINGLE - 1), F.lit(1))).alias("_w"))
    prints = windows.withColumn("_print", simhash(F.col("_w")))
    indexed = prints.withColumn("_b", block_values(F.col("_print"))).select(
        "*", F.posexplode("_b").alias("_i", "_v"))
    index = items.withColumn("_b2", block_values(F.col("_print"))).select(
        "_item", "item_id", F.col("m").alias("_m2"), F.col("_print").alias("_print2"), "_set", "_b2",
        F.posexplode("_b2").alias("_i2", "_v2"))
    # a pair is met once for every block it shares; the first counts
    first = F.array_position(F.zip_with("_b", "_b2", lambda a, b: a == b), True) == F.col("_i") + 1
    near = indexed.join(maybe(index), (F.col("m") == F.col("_m2")) & (F.col("_i") == F.col("_i2"))
                        & (F.col("_v") == F.col("_v2"))).where(
        first & (F.bit_count(F.col("_print").bitwiseXOR(F.col("_print2"))) <= RADIUS))
    both = F.size(F.array_intersect(counted(F.col("_w")), F.col("_set")))
    checked = near.withColumn("_both", both).withColumn(
        "_all", F.size("_w") + F.size("_set") - F.col("_both")).where(
        F.col("_both") * 100 >= F.col("_all") * PERCENT)
    return checked.select("doc_id", "_key", "_key2", "item_id", "start",
                          (F.col("_both") / F.col("_all")).alias("similarity"))


def op8(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id`` of every leak, the number of windows that match and the best similarity."""
    return leaks(docs, benchmark).groupBy("doc_id", "item_id").agg(
        F.count_distinct("_key", "start").alias("n_windows"),
        F.round(F.max("similarity"), 6).alias("similarity"))


def stage(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a leak, in their own columns."""
    bad = materialise(leaks(docs, benchmark).select("_key", "_key2").distinct().withColumn(
        "_bad", F.lit(True)))
    keyed = with_keys(docs.select(F.struct("*").alias("row"), "text")).drop("text")
    return lookup_join(keyed, bad, ["_key", "_key2"], 1_000_000).where("_bad is null").select("row.*")


def sql(source: str = "documents") -> str:
    """Every matching window by brute force over the shared shingles, for DuckDB; ends with ``found``."""
    return f"""
WITH dw AS (
  SELECT row_number() OVER () AS rid, d.doc_id AS doc_id, coalesce(d.text, '') AS text,
         regexp_extract_all(lower(coalesce(d.text, '')), '[^\\x20\\x09-\\x0D]+') AS w FROM {source} d),
iw AS (
  SELECT row_number() OVER () AS iid, item_id,
         regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+') AS w FROM benchmark),
dg AS (
  SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM dw, unnest(generate_series(1, greatest(len(w) - 4, least(len(w), 1)))) AS s(i)),
ig AS (
  SELECT iid, len(w) AS m, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM iw, unnest(generate_series(1, greatest(len(w) - 4, least(len(w), 1)))) AS s(i)),
starts AS (SELECT DISTINCT rid, d.i AS start, iid, m FROM dg d JOIN ig USING (g)),
wg AS (
  SELECT s.rid, s.start, s.iid, d.g, count(*) AS c
  FROM starts s JOIN dg d ON d.rid = s.rid AND d.i BETWEEN s.start AND s.start + greatest(m - 5, 0)
  GROUP BY ALL),
ic AS (SELECT iid, g, count(*) AS c FROM ig GROUP BY ALL),
isum AS (SELECT iid, sum(c) AS n FROM ic GROUP BY iid),
pairs AS (
  SELECT rid, start, w.iid, sum(least(w.c, coalesce(i.c, 0))) AS shared, sum(w.c) AS n
  FROM wg w LEFT JOIN ic i ON i.iid = w.iid AND i.g = w.g GROUP BY ALL),
found AS (
  SELECT rid, doc_id, item_id, start, shared / (p.n + s.n - shared) AS similarity
  FROM pairs p JOIN isum s USING (iid) JOIN iw USING (iid) JOIN dw USING (rid)
  WHERE shared * 100 >= (p.n + s.n - shared) * {PERCENT})"""


SQL = sql() + """
SELECT doc_id, item_id, count(DISTINCT start) AS n_windows, round(max(similarity), 6) AS similarity
FROM found GROUP BY doc_id, item_id"""
