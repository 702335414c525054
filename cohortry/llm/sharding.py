"""Sharding by a K-d tree over document metadata.

The tree starts with all documents and splits every node along its widest dimension (language, source or
size, each relative to its width over everything) at a weighted median of bytes, until a leaf reaches the
target bytes.  A node that owes an odd number of leaves is cut at the matching weighted quantile instead.

Medians are found for all nodes of a level at once: a histogram of bytes over the node's interval, then
one over the bin that holds the median, until that bin weighs next to nothing.  Where one value of the
dimension holds more, its rows are cut by a hash of the text, between two texts.  Rows of equal text share one
point, with the least language and source among them, so they come into one shard; only if they weigh more than
GROUP_SHARE of a shard and a cut falls among them are they cut too, by a hash of the row.  The driver holds one
row per node, at most as many as leaves.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.operators import materialise

from .common import lookup_join

DIMS = ["lang", "source", "bytes"]
BINS = 1024
#: The tie: 31 bits of the text's hash, then 31 of the row's.
TIE_BITS, ROW_BITS = 62, 31
GROUP_SHARE = 0.05
BROADCAST_ROWS = 1_000_000
SLICES = 64
LEVELS_STORED = 6


def _prefix(low: str | None, high: str | None) -> int:
    """Bytes that every string between the two shares."""
    a, b = (low or "").encode(), (high or "").encode()
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _text_code(c: Column, skip: int) -> Column:
    """A number in the order of the strings: the five bytes after the shared ones; 0 for NULL."""
    part = F.hex(F.substring(F.encode(c, "UTF-8"), skip + 1, 5))
    return F.coalesce(F.conv(F.rpad(part, 10, "0"), 16, 10).cast("long") + 1, F.lit(0))


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_size``, two hashes of the text, ``_k1`` and ``_k2``, and one of the row, ``_kr``; NULL text
    counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("*", size_of(F.col("text")).alias("_size"), F.xxhash64(text).alias("_k1"),
                       F.xxhash64(F.lit(2), text).alias("_k2"), F.xxhash64("doc_id", text, "lang", "source").alias("_kr"))


def with_point(rows: DataFrame, skips: dict[str, int]) -> DataFrame:
    """Measured rows with ``_pt``: weight, a whole number per dimension, and the tie.

    The least language and source (NULL first) of a text that stands more than once are looked up.
    """
    several = materialise(rows.groupBy("_k1", "_k2").agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct("lang", "source")).alias("_least")).where("_n > 1").drop("_n"))
    joined = lookup_join(rows, several, ["_k1", "_k2"], BROADCAST_ROWS)
    own = F.coalesce("_least", F.struct("lang", "source"))
    tie = F.shiftleft(F.shiftrightunsigned("_k1", 33), ROW_BITS).bitwiseOR(F.shiftrightunsigned("_kr", 33))
    return joined.withColumn("_pt", F.struct(
        F.col("_size").alias("size"),
        _text_code(own["lang"], skips["lang"]).alias("lang"),
        _text_code(own["source"], skips["source"]).alias("source"),
        F.floor(F.log2("_size") * 2 ** 30).cast("long").alias("bytes"),
        tie.alias("tie"))).drop("_size", "_k1", "_k2", "_kr", "_least")


def shared_prefixes(docs: DataFrame) -> dict[str, int]:
    low = docs.agg(*[f(c).alias(f"{n}_{c}") for c in ("lang", "source")
                     for n, f in (("lo", F.min), ("hi", F.max))]).first()
    return {c: _prefix(low[f"lo_{c}"], low[f"hi_{c}"]) for c in ("lang", "source")}


def _value(dim: Column) -> Column:
    out = F.lit(0).cast("long")
    for i, d in enumerate(DIMS):
        out = F.when(dim == i, F.col(f"_pt.{d}")).otherwise(out)
    return out


def descend(points: DataFrame, cuts: list[dict]) -> DataFrame:
    """``points`` one level down: left of its cut a node ``n`` becomes ``2 n``, else ``2 n + 1``.  Leaves
    stay.  The cuts are at most as many as leaves, so they are broadcast."""
    spark = points.sparkSession
    table = spark.createDataFrame([(c["node"], c["dim"], c["value"], c["tie"]) for c in cuts],
                                  "_cn long, _cd int, _cv long, _ct long")
    joined = points.join(F.broadcast(table), F.col("_node") == F.col("_cn"), "left")
    left = (_value(F.col("_cd")) < F.col("_cv")) | (
        (_value(F.col("_cd")) == F.col("_cv")) & (F.col("_pt.tie") < F.col("_ct")))
    return joined.withColumn("_node", F.when(F.col("_cn").isNull(), F.col("_node")).otherwise(
        2 * F.col("_node") + F.when(left, 0).otherwise(1))).drop("_cn", "_cd", "_cv", "_ct")


def _text_start(tie: int) -> int:
    return tie >> ROW_BITS << ROW_BITS


def _cut_level(points: DataFrame, open_nodes: list[dict], tolerance: float, group_tolerance: float) -> None:
    """Sets ``value`` and ``tie`` of every open node: rows before them hold its target bytes."""
    spark = points.sparkSession
    todo = list(open_nodes)
    while todo:
        step = [-(-(n["hi"] - n["lo"]) // BINS) for n in todo]
        # bins of whole texts, unless one text is cut
        step = [s if n["value"] is None or n.get("rows") else -(-s >> ROW_BITS) << ROW_BITS for n, s in zip(todo, step)]
        table = spark.createDataFrame(
            [(n["node"], n["dim"], n["value"], n["lo"], n["hi"], s, float(n["need"]))
             for n, s in zip(todo, step)],
            "_cn long, _cd int, _cv long, _lo long, _hi long, _st long, _need double")
        # _cv is NULL while the dimension itself is cut, then the one value whose ties are cut
        x = F.when(F.col("_cv").isNull(), _value(F.col("_cd"))).when(
            _value(F.col("_cd")) == F.col("_cv"), F.col("_pt.tie"))
        inside = points.join(F.broadcast(table), F.col("_node") == F.col("_cn")).select(
            "_cn", "_need", "_lo", "_st", F.col("_pt.size").alias("w"), x.alias("x")
        ).where("x >= _lo").join(F.broadcast(table.select(F.col("_cn").alias("_c2"), "_hi")),
                                 (F.col("_cn") == F.col("_c2")) & (F.col("x") < F.col("_hi")))
        bins = inside.groupBy("_cn", "_need", F.expr("(x - _lo) div _st").alias("b")).agg(
            F.sum("w").alias("w"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        upto = F.sum("w").over(Window.partitionBy("_cn").orderBy("b"))
        found = {r["_cn"]: r for r in bins.withColumn("upto", upto).where(
            "upto >= _need and upto - w < _need").collect()}  # one bin a node
        rest = []
        for n in todo:
            r = found.get(n["node"])
            if r is None:  # nothing left to divide
                n["value"], n["tie"] = (n["hi"], 0) if n["value"] is None else (n["value"], n["hi"])
                continue
            before, single = r["upto"] - r["w"], r["lo"] == r["hi"]
            if n["value"] is not None and not n.get("rows"):
                start, end = _text_start(r["lo"]), _text_start(r["hi"]) + (1 << ROW_BITS)
                one = end - start == 1 << ROW_BITS
                if r["w"] <= (group_tolerance if one else tolerance):
                    n["tie"] = start if n["need"] - before <= r["upto"] - n["need"] else end
                    continue
                n["need"] -= before
                n["rows"], n["lo"], n["hi"] = one, start, end
                rest.append(n)
                continue
            if r["w"] <= tolerance or (single and n["value"] is not None):
                near = r["lo"] if n["need"] - before <= r["upto"] - n["need"] else r["hi"] + 1
                n["value"], n["tie"] = (near, 0) if n["value"] is None else (n["value"], near)
                continue
            n["need"] -= before
            if single:
                n["value"], n["lo"], n["hi"] = r["lo"], 0, 1 << TIE_BITS
            else:
                n["lo"], n["hi"] = r["lo"], r["hi"] + 1
            rest.append(n)
        todo = rest


def grow(points: DataFrame, leaves: int | None, target_bytes: int | None,
         tolerance: float = 0.001) -> tuple[list[list[dict]], dict[int, int]]:
    """Cuts level by level, and the shard number of each leaf; ``points`` has ``_pt``."""
    def stats(p):
        return {r["_node"]: r for r in p.groupBy("_node").agg(
            F.sum("_pt.size").alias("w"),
            *[f(f"_pt.{d}").alias(f"{n}_{d}") for d in DIMS for n, f in (("lo", F.min), ("hi", F.max))]
        ).collect()}  # one row a node
    points = points.withColumn("_node", F.lit(1).cast("long"))
    levels, seen = [], stats(points)
    if not seen:
        return [], {1: 0}
    root = seen[1]
    leaves = leaves or max(1, math.ceil(root["w"] / target_bytes))
    owed, done, leaf = {1: leaves}, {}, root["w"] / leaves
    while owed:
        cuts = []
        for node, m in list(owed.items()):
            r = seen.get(node)
            if m == 1 or r is None:
                done[node] = owed.pop(node)
                continue
            def width(d):
                return (r[f"hi_{d}"] - r[f"lo_{d}"]) / max(1, root[f"hi_{d}"] - root[f"lo_{d}"])
            dim = max(range(len(DIMS)), key=lambda i: (width(DIMS[i]), -i))
            cuts.append({"node": node, "dim": dim, "value": None, "tie": 0, "lo": r[f"lo_{DIMS[dim]}"],
                         "hi": r[f"hi_{DIMS[dim]}"] + 1, "need": r["w"] * (m // 2) / m})
        if not cuts:
            break
        _cut_level(points, cuts, tolerance * leaf, GROUP_SHARE * leaf)
        points = descend(points, cuts)
        levels.append(cuts)
        if len(levels) % LEVELS_STORED == 0:
            points = materialise(points)
        owed = {k: v for c in cuts for m in [owed[c["node"]]]
                for k, v in ((2 * c["node"], m // 2), (2 * c["node"] + 1, m - m // 2))}
        seen = stats(points)
    depth = max(n.bit_length() for n in done)
    order = sorted(done, key=lambda n: n << (depth - n.bit_length()))
    first, at = {}, 0
    for n in order:  # a node without rows may owe several
        first[n], at = at, at + done[n]
    return levels, first


def place(docs_with_point: DataFrame, levels: list[list[dict]], first: dict[int, int]) -> DataFrame:
    """Adds ``_shard``; no shuffle."""
    out = docs_with_point.withColumn("_node", F.lit(1).cast("long"))
    for cuts in levels:
        out = descend(out, cuts)
    spark = out.sparkSession
    names = spark.createDataFrame(list(first.items()), "_cn long, _shard int")
    return out.join(F.broadcast(names), F.col("_node") == F.col("_cn"), "left").drop("_cn", "_node")


def with_slots(placed: DataFrame) -> DataFrame:
    """Adds ``_slot``, gapless from 0 in each shard: counted per hash slice of a shard, so that no shard
    is numbered by one task."""
    sliced = placed.withColumn("_slice", F.pmod(F.xxhash64("_pt.tie"), F.lit(SLICES)).cast("int"))
    counts = sliced.groupBy("_shard", "_slice").agg(F.count("*").alias("_n"))
    offset = F.sum("_n").over(Window.partitionBy("_shard").orderBy("_slice")) - F.col("_n")
    starts = counts.select(F.col("_shard").alias("_ks"), F.col("_slice").alias("_kl"),
                           offset.alias("_offset"))  # shards x slices rows
    number = F.row_number().over(Window.partitionBy("_shard", "_slice").orderBy(
        "_pt.tie", F.col("doc_id").asc_nulls_first()))
    return sliced.withColumn("_slot", number - 1).join(
        F.broadcast(starts), (F.col("_shard") == F.col("_ks")) & (F.col("_slice") == F.col("_kl"))
    ).withColumn("_slot", F.col("_slot") + F.col("_offset")).drop("_ks", "_kl", "_slice", "_offset")


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """``row`` (a struct of all columns), ``doc_id``, ``_pt`` (weight and coordinates) and ``_shard``, 0
    upward; give the number of shards or the bytes of one.

    NULL metadata sorts first, NULL text weighs its row alone.  Rows of equal text stay together up to
    GROUP_SHARE of a shard, rows equal in id, text, language and source at any size; an empty table gives no
    rows.  Further columns, of any name, stay in ``row``.
    The tree is grown on stored coordinates, without the texts, and then applied to ``docs`` row by row.
    """
    rows = measured(docs.select(F.struct("*").alias("row"), "doc_id", "text", "lang", "source")).drop("text")
    pointed = with_point(rows, shared_prefixes(docs)).drop("lang", "source")
    levels, first = grow(materialise(pointed.select("_pt")), shards, target_bytes)
    return place(pointed, levels, first)


def op1(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Shard and slot per document, in the columns of the contract; the law is ``bytes``."""
    rows = materialise(measured(docs.select("doc_id", "text", "lang", "source")).withColumn(
        "text_crc32", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))).drop("text"))
    pointed = materialise(with_point(rows, shared_prefixes(docs)).select("doc_id", "_pt", "text_crc32"))
    numbered = with_slots(place(pointed, *grow(pointed, shards, None)))
    return numbered.select("doc_id", F.col("_pt.size").alias("size"), "text_crc32",
                           F.lit("bytes").alias("law"), F.col("_shard").alias("shard"),
                           F.col("_slot").cast("long").alias("slot"),
                           F.lit(None).cast("int").alias("grown_shard"))


def stage(docs: DataFrame, shards: int = 24) -> DataFrame:
    """``docs`` with their ``shard``, which replaces a column of that name."""
    own = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() != "shard"]
    return shard(docs, shards).select(*own, F.col("_shard").alias("shard"))
