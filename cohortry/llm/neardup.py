"""Near duplicates by MinHash with odd sketches.

A text's set is its distinct shingles, of four words unless told otherwise.  BANDS bands of ROWS MinHash values name buckets; a pair
at similarity 0.8 meets in one with probability 1 - 5e-6.  The MinHash samples are also folded into a
bitmap of parities, the odd sketch: the bits in which two bitmaps differ tell how many samples differ,
most precisely where few do.  Only pairs whose sketches allow the similarity are compared on full sets.

Texts with equal sets form one class first, so copies cost nothing further.  Pairs are taken in two
steps, so that a bucket of m texts does not give m^2 pairs:

1. every text of a bucket against the two texts of least and greatest hash in it; verified links give
   components;
2. all buckets with the same least text form a group.  Groups that still hold several components are cut
   into chunks, and one task takes two chunks: it compares sketches and then full sets of all pairs from
   different components, and returns the links that join components.  After this no meeting pair is left
   unchecked, for pairs within one component cannot change the result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.operators import materialise

from .components import connected_components
from .tokens import ODD, chunks, mix, powers, windows_hash, word_hashes

SHINGLE = 4
ROWS, BANDS = 6, 40
SAMPLES = ROWS * BANDS
SKETCH_BITS = 1024
PERCENT = 80
#: Pairs estimated as low as this are still compared: the filter misses fewer pairs at 0.8 than the bands do.
ESTIMATE = 0.64
CHUNK = 512


def differing_bits(similarity: float) -> int:
    """Bits in which the sketches of two sets of this similarity differ on average."""
    apart = 2 * SAMPLES * (1 - similarity)
    return round(SKETCH_BITS / 2 * (1 - math.exp(-2 * apart / SKETCH_BITS)))


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle, an empty one none."""
    hashes, at = word_hashes(texts, lower=True)
    grams = windows_hash(hashes, shingle)
    for lo, hi in zip(at[:-1], at[1:]):
        if hi - lo >= shingle:
            yield np.unique(grams[lo:hi - shingle + 1])
        elif hi > lo:
            own = hashes[lo:hi] * powers(0xA0761D6478BD642F, hi - lo)
            yield mix(np.array([own.sum(dtype=np.uint64) + np.uint64(hi - lo)]))
        else:
            yield hashes[:0]


def _signatures(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    seeds = mix(np.arange(1, 2 * SAMPLES + 1, dtype=np.uint64) * ODD)
    a, b = seeds[:SAMPLES].astype(np.uint32) | np.uint32(1), seeds[SAMPLES:].astype(np.uint32)
    spread = mix(np.arange(7, SAMPLES + 7, dtype=np.uint64) * ODD)
    for batch in batches:
        for part, texts in chunks(batch):
            n, key, bands, sketches = [], [], [], []
            for s in shingle_sets(texts, shingle):
                n.append(len(s))
                if not len(s):
                    key.append((0, 0)), bands.append([]), sketches.append([])
                    continue
                low = np.full(SAMPLES, 0xFFFFFFFF, dtype=np.uint32)
                short = (s >> np.uint64(32)).astype(np.uint32)
                for i in range(0, len(short), 4096):
                    np.minimum(low, (np.multiply.outer(a, short[i:i + 4096]) + b[:, None]).min(axis=1),
                               out=low)
                tagged = mix(low.astype(np.uint64) + spread)
                parity = np.bincount((tagged >> np.uint64(54)).astype(np.int64), minlength=SKETCH_BITS) & 1
                key.append(np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), "<i8"))
                bands.append(mix(tagged.reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64)).view(np.int64))
                sketches.append(np.packbits(parity.astype(np.uint8)).view("<i8"))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("t1"), part.column("t2"), pa.array(n, pa.int64()),
                 pa.array([int(k[0]) for k in key], pa.int64()),
                 pa.array([int(k[1]) for k in key], pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))],
                names=["doc_id", "t1", "t2", "n", "k1", "k2", "bands", "sketch"])


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in chunks(batch):
            sets = [s.view(np.int64) for s in shingle_sets(texts, shingle)]
            yield pa.RecordBatch.from_arrays(
                [part.column("cid"), pa.array(sets, pa.list_(pa.int64()))], names=["cid", "set"])


def text_keys(docs: DataFrame) -> DataFrame:
    """``docs`` with ``t1, t2``, two hashes of the text; NULL counts as empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("t1", F.xxhash64(F.lit(1), text)).withColumn("t2", F.xxhash64(F.lit(2), text))


def _apart(a: str, b: str) -> Column:
    return sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))))
                for i in range(SKETCH_BITS // 64)), F.lit(0))


def _near(a: str = "sketch", b: str = "sketch2") -> Column:
    return _apart(a, b) <= differing_bits(ESTIMATE)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full sets reach the similarity."""
    both = pairs.join(sets.select(F.col("cid").alias("a"), F.col("set").alias("sa")), "a").join(
        sets.select(F.col("cid").alias("b"), F.col("set").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.withColumn("shared", shared).where(
        F.col("shared") * 100 >= (F.size("sa") + F.size("sb") - F.col("shared")) * PERCENT
    ).select("a", "b")


def _full_sets(docs: DataFrame, classes: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """``cid, set`` of the classes in ``ids``, from one of their texts each."""
    wanted = ids.distinct().join(classes.select("cid", "t1", "t2"), "cid")
    texts = text_keys(docs.select("text")).join(wanted, ["t1", "t2"]).groupBy("cid").agg(
        F.first("text").alias("text"))
    return materialise(texts.mapInArrow(partial(_sets, shingle=shingle), "cid long, set array<long>"))


def _joining(table: pa.Table) -> pa.Table:
    """Links between components among the texts of two chunks, as many as join them."""
    own = {c: table.column(c).to_numpy() for c in ("cid", "root", "chunk", "i", "j")}
    left, right = own["chunk"] == own["i"], own["chunk"] == own["j"]
    out: list[tuple[int, int]] = []
    if len(np.unique(own["root"])) > 1:
        sketch = np.stack([np.array(x.as_py(), dtype=np.int64) for x in table.column("sketch")]).view(np.uint64)
        sets = [x.values.to_numpy().view(np.uint64) for x in table.column("set")]
        a, b = np.flatnonzero(left), np.flatnonzero(right)
        near = own["root"][a][:, None] != own["root"][b][None, :]
        apart = np.zeros(near.shape, dtype=np.int32)
        for k in range(sketch.shape[1]):
            apart += np.bitwise_count(sketch[a, k][:, None] ^ sketch[b, k][None, :])
        near &= apart <= differing_bits(ESTIMATE)
        a, b, near = a[near.any(axis=1)], b[near.any(axis=0)], near[near.any(axis=1)][:, near.any(axis=0)]
        shared = _shared([sets[x] for x in a], [sets[x] for x in b])
        size = np.array([len(x) for x in sets])
        linked = near & (100 * shared >= PERCENT * (size[a][:, None] + size[b][None, :] - shared))
        group = {r: r for r in own["root"].tolist()}

        def find(r):
            while group[r] != r:
                group[r] = r = group[group[r]]
            return r
        for x, y in zip(*np.nonzero(linked)):
            r, t = find(int(own["root"][a[x]])), find(int(own["root"][b[y]]))
            if r != t:
                group[r] = t
                out.append((int(own["cid"][a[x]]), int(own["cid"][b[y]])))
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``left`` with every set of ``right``."""
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    if not left or not right:
        return out
    common = np.intersect1d(np.concatenate(left), np.concatenate(right))
    for i in range(0, len(common), 2048):  # a slice of the shingles that both sides have
        part = common[i:i + 2048]
        held = []
        for side in (left, right):
            m = np.zeros((len(side), len(part)), dtype=np.float32)
            for row, s in enumerate(side):
                lo, hi = np.searchsorted(s, [part[0], part[-1]], side="left")
                inside = s[lo:hi + 1]
                at = np.searchsorted(part, inside)
                ok = at < len(part)
                m[row, at[ok][part[at[ok]] == inside[ok]]] = 1
            held.append(m)
        out += (held[0] @ held[1].T).astype(np.int64)
    return out


def _joining_links(docs: DataFrame, classes: DataFrame, members: DataFrame, roots: DataFrame,
                   shingle: int) -> DataFrame:
    """Links ``a, b`` between texts of different components that meet in a bucket, enough to join these."""
    group = members.select(F.col("lo").alias("c"), "cid").distinct().join(roots, "cid", "left").withColumn(
        "root", F.coalesce("root", "cid"))
    mixed = group.groupBy("c").agg(F.min("root").alias("x"), F.max("root").alias("y"),
                                   F.count("*").alias("n")).where("x <> y").select(
        "c", F.ceil(F.col("n") / CHUNK).alias("chunks"))
    todo = materialise(group.join(mixed, "c").withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("chunks"))))
    whole = _full_sets(docs, classes, todo.select("cid"), shingle).join(classes.select("cid", "sketch"), "cid")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    dealt = todo.withColumn("o", other).select(
        "c", F.least("chunk", "o").alias("i"), F.greatest("chunk", "o").alias("j"), "chunk", "cid", "root"
    ).join(whole, "cid")
    return dealt.groupBy("c", "i", "j").applyInArrow(_joining, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id, t1, t2`` (hashes of the text), ``n`` (set size) and ``root``, the same for all texts of a
    component; NULL for a text without words, which is linked with nothing.

    NULL text counts as empty, NULL ids are rows like others, repeated rows give repeated rows; an empty
    table gives none.  Texts are read whole; all links of similarity 0.8 or more, on shingles of ``shingle``
    words, count.
    """
    table = materialise(text_keys(docs.select("doc_id", "text")).mapInArrow(
        partial(_signatures, shingle=shingle), "doc_id long, t1 long, t2 long, n long, k1 long, k2 long, bands array<long>, "
        "sketch array<long>"))
    classes = materialise(table.where("n > 0").groupBy("k1", "k2").agg(
        F.min(F.struct("t1", "t2")).alias("t"), F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch")).select(
        F.monotonically_increasing_id().alias("cid"), "k1", "k2", "t.t1", "t.t2", "bands", "sketch"))
    rows = classes.select("cid", F.explode_outer("bands").alias("v"))
    rank = F.struct(F.xxhash64("cid").alias("h"), F.col("cid"))
    buckets = materialise(rows.groupBy("v").agg(
        F.min(rank)["cid"].alias("lo"), F.max(rank)["cid"].alias("hi")).where("lo <> hi"))
    members = materialise(rows.join(buckets, "v"))
    light = classes.select("cid", "sketch")
    star = members.select("cid", F.explode(F.array("lo", "hi")).alias("c")).where("cid <> c").select(
        F.least("cid", "c").alias("a"), F.greatest("cid", "c").alias("b")).distinct()
    first = materialise(
        star.join(light.withColumnsRenamed({"cid": "a"}), "a")
        .join(light.withColumnsRenamed({"cid": "b", "sketch": "sketch2"}), "b").where(_near())
        .select("a", "b"))
    sets = _full_sets(docs, classes, first.select(F.col("a").alias("cid")).union(first.select("b")), shingle)
    links = materialise(_verified(first, sets))
    roots = connected_components(links)
    light_roots = roots.withColumnRenamed("node", "cid")
    more = materialise(_joining_links(docs, classes, members, light_roots, shingle))
    final = connected_components(links.union(more)).withColumnRenamed("node", "cid")
    named = classes.select("k1", "k2", "cid").join(final, "cid", "left").select(
        "k1", "k2", F.coalesce("root", "cid").alias("root"))
    return materialise(table.select("doc_id", "t1", "t2", "n", "k1", "k2").join(
        named, ["k1", "k2"], "left").select(
        "doc_id", "t1", "t2", "n", F.when(F.col("n") > 0, F.col("root")).alias("root")))


def op5(docs: DataFrame) -> DataFrame:
    """Component of each document, in the columns of the contract.  A component of NULL ids has none."""
    found = near_duplicates(docs, SHINGLE)
    least = found.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = found.join(least, "root", "left").withColumn(
        "component_id", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return named.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def stage(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One document of each component, that of the least id; of repeated rows one.  Documents without
    words stay.  ``shingle`` is the number of words that similarity counts by."""
    found = near_duplicates(docs, shingle)
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t1", "t2")
    keep = found.where("root is not null").groupBy("root").agg(F.min(row).alias("r")).select(
        F.col("r.doc_id").alias("_id"), F.col("r.t1").alias("t1"), F.col("r.t2").alias("t2")).union(
        found.where("root is null").select("doc_id", "t1", "t2").distinct())
    rest = [c for c in docs.columns if c != "doc_id"]
    whole = docs.select("doc_id", F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_rest"), "text")
    kept = text_keys(whole).drop("text").join(
        keep.withColumnsRenamed({"t1": "_t1", "t2": "_t2"}),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("t1") == F.col("_t1"))
        & (F.col("t2") == F.col("_t2")))
    # of repeated rows the least; any where a column has no order
    kind = kept.schema["_rest"].dataType.simpleString()
    pick = F.first if "map<" in kind or "variant" in kind else F.min
    one = kept.groupBy("doc_id", "t1", "t2").agg(pick("_rest").alias("_rest"))
    return one.select(*[F.col("doc_id" if c == "doc_id" else f"_rest.`{c}`") for c in docs.columns])
