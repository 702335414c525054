"""How far the sources of a language lie apart, term by term: a frequent-pattern tree of term rows.

The row of a term lists the sources of its language that use it, in one order of sources, each with the
share it gives the term.  Equal rows are one row with a multiplicity.  Inserted in a prefix tree, rows with
a common beginning share their nodes, and a node counts the terms below it.  The divergence of two sources
sums over all terms, most of which one of them or both do not use.  It is split so that only terms of both
need a look at the pair:

* every term as if unused by both: the number of terms times one value;
* the terms of one source, as if unused by the other: a histogram of its shares against each other source;
* a correction for each term of both: a node and one of its ancestors, times the node's count.

The rows are range-partitioned in order, so that each task holds a part of the tree, and the corrections of
a task are summed before they are shuffled.  Shares are whole numbers of 10^-9 and all sums are exact.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.operators import materialise

#: Letters and everything beyond ASCII, on UTF-8 bytes and for SQL on code points.
TERM = re.compile(rb"[A-Za-z\x80-\xFF]+")
TERM_SQL = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
UNIT = 1_000_000_000
#: A text longer than this is counted match by match, without a list of its terms.
LIST_BYTES = 1 << 22
#: Entries that a task counts, and entries of term rows and pairs of nodes that it holds, before it passes them on.
TALLY, ROW_ENTRIES, NODE_PAIRS = 300_000, 200_000, 1_000_000


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by language and source, summed over part of a partition."""
    tally: dict[tuple[str, str], tuple[dict, Counter]] = {}
    held = 0

    def flush():
        cols = [[], [], [], [], []]
        for (lang, source), (n, docs) in tally.items():
            cols[0] += [lang] * len(n)
            cols[1] += [source] * len(n)
            cols[2] += n.keys()
            cols[3] += n.values()
            cols[4] += [docs[t] for t in n]
        kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          names=["lang", "source", "term", "n", "docs"])
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text"))):
            raw = text.as_buffer().to_pybytes().translate(LOWER)
            found = TERM.findall(raw) if len(raw) <= LIST_BYTES else (m.group() for m in TERM.finditer(raw))
            here = Counter(found)
            n, docs = tally.setdefault((lang.as_py(), source.as_py()), ({}, Counter()))
            held -= len(n)
            for term, times in here.items():
                n[term] = n.get(term, 0) + times
            docs.update(here.keys())
            held += len(n)
            if held > TALLY:
                yield flush()
                tally, held = {}, 0
    if tally:
        yield flush()


def term_rows(docs: DataFrame, min_docs: int = 3) -> DataFrame:
    """``lang, term, total, uses`` (``source, n`` of each source that has the term) of every term that at
    least ``min_docs`` documents of its language hold."""
    counted = docs.mapInArrow(_count, "lang string, source string, term binary, n long, docs long")
    by_source = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    rows = by_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"),
        F.collect_list(F.struct("source", "n")).alias("uses"))
    return rows.where(F.col("docs") >= min_docs).select(
        "lang", F.col("term").cast("string").alias("term"), "total", "uses")


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (total + terms)), exact at any size; 1 without terms."""
    wide = (F.lit(UNIT).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)"))
    return F.when(terms > 0, F.call_function("div", wide, (total + terms).cast("decimal(20,0)")) + 1
                  ).otherwise(F.lit(1)).cast("long")


def apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)"""
    return F.call_function("div", (p - q) * (p - q), q)


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _common(lengths: np.ndarray, lang: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Entries that each row has in common with the row before it, from the start; rows lie end to end."""
    begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    out = np.zeros(len(lengths), np.int64)
    both = np.minimum(lengths[1:], lengths[:-1])
    both[lang[1:] != lang[:-1]] = 0
    rows = np.flatnonzero(both)
    if not len(rows):
        return out
    size = both[rows]
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    step = np.arange(size.sum()) - np.repeat(first, size)
    same = (values[:, np.repeat(begin[1:][rows], size) + step]
            == values[:, np.repeat(begin[:-1][rows], size) + step]).all(axis=0)
    out[rows + 1] = np.minimum.reduceat(np.where(same, np.repeat(size, size), step), first)
    return out


def _nodes(lengths: np.ndarray, common: np.ndarray, times: np.ndarray):
    """(row, depth, terms) of the nodes of rows in order; a node belongs to the first row that has it."""
    alive, depth = np.arange(len(lengths)), 0
    alive = alive[lengths > 0]
    while len(alive):
        new = np.flatnonzero(common[alive] <= depth)
        yield alive[new], depth, np.add.reduceat(times[alive], new)
        depth += 1
        alive = alive[lengths[alive] > depth]


def _corrections(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Sums over node and ancestor of a batch of term rows in order: ``lang, a, b, ab, ba``."""
    path = batch.column("path")
    flat = path.flatten()
    values = np.stack([np.asarray(flat.field(k), np.int64) for k in range(3)])  # source, share, share if unused
    lengths = np.asarray(path.value_lengths(), np.int64)
    begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    names, lang = np.unique(np.asarray(batch.column("lang").to_pylist(), dtype=object), return_inverse=True)
    common = _common(lengths, lang, values)
    width = int(values[0].max(initial=0)) + 1
    nodes = [np.stack([r, np.full(len(r), d), t]) for r, d, t in
             _nodes(lengths, common, np.asarray(batch.column("times"), np.int64)) if d]
    if not nodes:
        return
    row, depth, terms = np.concatenate(nodes, axis=1)
    pairs = np.cumsum(depth)
    start = 0
    while start < len(row):
        end = max(start + 1, int(np.searchsorted(pairs, (pairs[start - 1] if start else 0) + NODE_PAIRS, "right")))
        d = depth[start:end]
        first = np.concatenate(([0], np.cumsum(d)[:-1]))
        node = np.repeat(begin[row[start:end]] + d, d)
        over = np.repeat(begin[row[start:end]], d) + np.arange(d.sum()) - np.repeat(first, d)
        (a, pa_, za), (b, pb, zb), m = values[:, over], values[:, node], np.repeat(terms[start:end], d)
        ab = m * (_apart(pa_, pb) - _apart(pa_, zb) - _apart(za, pb) + _apart(za, zb))
        ba = m * (_apart(pb, pa_) - _apart(pb, za) - _apart(zb, pa_) + _apart(zb, za))
        key = (np.repeat(lang[row[start:end]], d) * width + a) * width + b
        order = np.argsort(key, kind="stable")
        at = np.flatnonzero(np.diff(key[order], prepend=-1))
        keys = key[order][at]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[keys // width // width], pa.string()), pa.array(keys // width % width, pa.int64()),
             pa.array(keys % width, pa.int64()), pa.array(np.add.reduceat(ab[order], at)),
             pa.array(np.add.reduceat(ba[order], at))], names=["lang", "a", "b", "ab", "ba"])
        start = end


def _tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections of the tree of a partition, part by part; rows come in order."""
    held, entries = [], 0
    for batch in batches:
        at = 0
        sizes = np.cumsum(np.asarray(batch.column("path").value_lengths(), np.int64))
        while at < len(batch):
            room = ROW_ENTRIES - entries + (sizes[at - 1] if at else 0)
            end = max(at + 1, int(np.searchsorted(sizes, room, "right")))
            held.append(batch.slice(at, end - at))
            entries += int(sizes[end - 1] - (sizes[at - 1] if at else 0))
            at = end
            if entries >= ROW_ENTRIES or at < len(batch):
                yield from _corrections(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                held, entries = [], 0
    if held:
        yield from _corrections(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def source_divergence(docs: DataFrame, min_docs: int = 3, top: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every language and source of ``docs``.

    Part ``pair``: for each other source of the language, the sum of floor((p - q)^2 / q) over the terms that
    at least ``min_docs`` documents of the language hold; p and q are the smoothed shares of the source and
    the other.  Part ``term``: the ``top`` terms that the source uses more than its language, by the same
    value against the language.  Ranks go by value, ties by item in UTF-8 order.

    NULL ``text``, ``lang`` and ``source`` count as empty; an empty language or source is one like any
    other.  Every row is a document: repeated rows count again.  A source without terms has its pairs; in a
    language without kept terms their value is 0.  An empty table gives no rows.  Other columns are not read.
    """
    own = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    rows = materialise(term_rows(own, min_docs))
    uses = rows.select("lang", "term", "total", F.inline("uses"))
    of_lang = rows.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("all_n"))
    of_group = uses.groupBy("lang", "source").agg(F.sum("n").alias("group_n"), F.count("*").alias("used"))
    groups = (own.select("lang", "source").distinct().join(of_lang, "lang", "left")
              .join(of_group, ["lang", "source"], "left").na.fill(0))
    # the sources with most terms first: more rows begin alike
    groups = materialise(groups.withColumn("i", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.desc("used"), "source")) - 1).withColumn(
        "z", share(F.lit(0).cast("long"), F.col("group_n"), F.col("v"))))
    shares = materialise(uses.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "i", "z", share(F.col("n"), F.col("group_n"), F.col("v")).alias("p"),
        share(F.col("total"), F.col("all_n"), F.col("v")).alias("q")))
    # term rows in order of their entries, each once with the number of its terms
    paths = materialise(shares.groupBy("lang", "term").agg(
        F.sort_array(F.collect_list(F.struct("i", "p", "z"))).alias("path"))
        .groupBy("lang", "path").agg(F.count("*").alias("times")))
    tree = paths.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path").mapInArrow(
        _tree, "lang string, a long, b long, ab long, ba long")
    shared = tree.select("lang", F.inline(F.array(
        F.struct(F.col("a").alias("i"), F.col("b").alias("j"), F.col("ab").alias("value")),
        F.struct(F.col("b").alias("i"), F.col("a").alias("j"), F.col("ba").alias("value")))))
    other = groups.select(F.col("lang"), F.col("i").alias("j"), F.col("z").alias("y"), F.col("source").alias("item"))
    histogram = shares.groupBy("lang", "i", "z", "p").agg(F.count("*").alias("m"))
    single = histogram.join(other, "lang").where("i <> j").select("lang", F.inline(F.array(
        F.struct(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"),
                 (F.col("m") * (apart(F.col("p"), F.col("y")) - apart(F.col("z"), F.col("y")))).alias("value")),
        F.struct(F.col("j").cast("long").alias("i"), F.col("i").cast("long").alias("j"),
                 (F.col("m") * (apart(F.col("y"), F.col("p")) - apart(F.col("y"), F.col("z")))).alias("value")))))
    changes = shared.unionByName(single).groupBy("lang", "i", "j").agg(F.sum("value").alias("change"))
    pairs = groups.join(other, "lang").where("i <> j").join(changes, ["lang", "i", "j"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item",
        (F.col("v") * apart(F.col("z"), F.col("y")) + F.coalesce("change", F.lit(0))).cast("long").alias("value"))
    terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         apart(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(
        terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))


def op11(docs: DataFrame) -> DataFrame:
    return source_divergence(docs)


SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '{TERM_SQL}') AS ws FROM documents),
tok AS (SELECT rid, lang, source, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term FROM tok GROUP BY ALL HAVING count(DISTINCT rid) >= 3),
cnt AS (SELECT lang, source, term, count(*) AS c FROM tok JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
gn AS (
  SELECT g.lang, g.source, coalesce(v.v, 0) AS v, coalesce(sum(c), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN v USING (lang) LEFT JOIN cnt USING (lang, source)
  GROUP BY ALL),
ln AS (
  SELECT lang, term, 1 + (1000000000 * (sum(c) + 1)) // (any_value(s.n) + any_value(v.v)) AS q
  FROM cnt JOIN v USING (lang) JOIN (SELECT lang, sum(c) AS n FROM cnt GROUP BY lang) s USING (lang)
  GROUP BY lang, term),
p AS (
  SELECT gn.lang, gn.source, kept.term, coalesce(c, 0) AS c,
         1 + (1000000000 * (coalesce(c, 0) + 1)) // (n + v) AS p
  FROM gn JOIN kept USING (lang) LEFT JOIN cnt USING (lang, source, term)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM gn g JOIN gn h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source),
term AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
  FROM p JOIN ln USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
  FROM (FROM pair UNION ALL FROM term))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200"""
