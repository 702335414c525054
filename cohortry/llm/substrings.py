"""Substring de-duplication by relative Lempel-Ziv parsing.

The corpus is its own reference.  Its windows of ``WINDOW`` words are indexed by hash, the index being
dealt out over blocks; a text is parsed against every block that can hold one of its windows.  Parsing is
greedy: from a window found in the reference a factor goes on as long as the next window continues at the
next place of the same reference text.  Where it breaks off, the windows across the boundary are looked
up in their own right, so no duplicate that straddles two factors is lost.  Every factor has at least
``WINDOW`` words and becomes a duplicate span.

Not every window is indexed: of each window the 8 words of least hash are its anchor.  Equal windows have
equal anchors, so a window whose anchor occurs once in the corpus is unique.  Anchors are about a
fourteenth of all words.  Copies of a text are parsed once; all their windows occur elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.operators import materialise

from .neardup import text_keys
from .tokens import chunks, windows_hash, word_hashes

WINDOW = 35
ANCHOR = 8


def _anchor_places(grams: np.ndarray) -> np.ndarray:
    """For each window of a text, where its anchor begins: the first of the least gram hashes."""
    span = WINDOW - ANCHOR + 1
    if len(grams) < span:
        return np.empty(0, dtype=np.int64)
    inner = np.lib.stride_tricks.sliding_window_view(grams, span)
    step = 1 << 15
    return np.concatenate([inner[i:i + step].argmin(axis=1) + np.arange(i, min(i + step, len(inner)))
                           for i in range(0, len(inner), step)])


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in chunks(batch):
            hashes, at = word_hashes(texts)
            grams = windows_hash(hashes, ANCHOR)
            found, places = [], []
            for lo, hi in zip(at[:-1], at[1:]):
                own = grams[lo:max(lo, hi - ANCHOR + 1)]
                where = np.unique(_anchor_places(own))
                places.append(where.astype(np.int32)), found.append(own[where].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column("t1"), part.column("t2"), pa.array(found, pa.list_(pa.int64())),
                 pa.array(places, pa.list_(pa.int32()))], names=["t1", "t2", "anchors", "places"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Start and hash of the windows whose anchor is at one of ``shared``."""
    for batch in batches:
        for part, texts in chunks(batch):
            hashes, at = word_hashes(texts)
            grams, whole = windows_hash(hashes, ANCHOR), windows_hash(hashes, WINDOW)
            starts, values = [], []
            for lo, hi, shared in zip(at[:-1], at[1:], part.column("shared")):
                anchor = _anchor_places(grams[lo:max(lo, hi - ANCHOR + 1)])
                where = np.flatnonzero(np.isin(anchor, np.array(shared.as_py(), dtype=np.int64)))
                starts.append(where.astype(np.int32)), values.append(whole[lo + where].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column("no"), pa.array(starts, pa.list_(pa.int32())),
                 pa.array(values, pa.list_(pa.int64()))], names=["no", "starts", "values"])


def factors(hits: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Greedy parse of a text's windows found in the reference, ``(start, reference text, reference start)``
    in order, into factors ``(start, words, reference text, reference start)``."""
    out: list[list[int]] = []
    for at, text, ref in hits:
        last = out[-1] if out else None
        if last and last[2] == text and at == last[0] + last[1] - WINDOW + 1 and ref - last[3] == at - last[0]:
            last[1] += 1
        else:
            out.append([at, WINDOW, text, ref])
    return [tuple(x) for x in out]


FACTORS = "array<struct<start:int,words:int,ref_no:long,ref:int>>"


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("ref_no", pa.int64()),
                               ("ref", pa.int32())]))
    for batch in batches:
        out = [[dict(zip(("start", "words", "ref_no", "ref"), f)) for f in factors(
            [(h["start"], h["ref_no"], h["ref"]) for h in hits.as_py()])] for hits in batch.column("hits")]
        yield pa.RecordBatch.from_arrays([batch.column("no"), pa.array(out, kind)], names=["no", "factors"])


def keep_words(text: bytes, spans: list[tuple[int, int]], copied: bool) -> tuple[int, bytes]:
    """Number of words and the words outside the spans ``(start, words)``, joined by one space; with
    ``copied``, all words of a text with a window go."""
    words = text.split()
    if copied:
        return len(words), b" ".join(words) if len(words) < WINDOW else b""
    out, at = [], 0
    for start, n in spans:
        out += words[at:start]
        at = max(at, start + n)
    return len(words), b" ".join(out + words[at:])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in chunks(batch):
            total, kept = [], []
            for t, spans, copied in zip(texts, part.column("factors"), part.column("copied")):
                pairs = [(s["start"], s["words"]) for s in spans.as_py() or ()]
                n, rest = keep_words(t, pairs, bool(copied.as_py()))
                total.append(n), kept.append(rest.decode())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(total, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "kept_text"])


def parse(docs: DataFrame) -> DataFrame:
    """``t1, t2`` (hashes of a text), ``copies`` (rows with it), ``no`` (a number of the text) and its
    ``factors`` (``start, words`` and the reference: text ``ref_no`` and place ``ref``, in words), for
    texts that have copies or factors.

    NULL text counts as empty and has no windows, as have texts under 35 words.  Equal windows in one
    text count; repeated rows are copies.
    """
    keyed = text_keys(docs.select("text"))
    copies = keyed.groupBy("t1", "t2").agg(F.count("*").alias("copies")).where("copies > 1")
    anchors = materialise(keyed.mapInArrow(
        _anchors, "t1 long, t2 long, anchors array<long>, places array<int>").where(
        F.size("anchors") > 0).groupBy("t1", "t2").agg(
        F.first("anchors").alias("anchors"), F.first("places").alias("places")).select(
        F.monotonically_increasing_id().alias("no"), "*"))
    named = anchors.select("no", "t1", "t2")
    each = anchors.select("no", F.explode_outer(F.arrays_zip("anchors", "places")).alias("a")).select(
        "no", F.col("a.anchors").alias("anchor"), F.col("a.places").alias("place"))
    twice = each.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    shared = each.join(twice, "anchor").groupBy("no").agg(F.collect_list("place").alias("shared"))
    texts = keyed.join(materialise(shared.join(named, "no")), ["t1", "t2"]).groupBy("t1", "t2").agg(
        F.first("no").alias("no"), F.first("text").alias("text"), F.first("shared").alias("shared"))
    windows = materialise(texts.mapInArrow(_windows, "no long, starts array<int>, values array<long>"))
    place = windows.select("no", F.explode_outer(F.arrays_zip("starts", "values")).alias("w")).select(
        F.col("w.values").alias("value"), F.struct("no", F.col("w.starts").alias("start")).alias("p"))
    index = place.groupBy("value").agg(F.min("p").alias("lo"), F.max("p").alias("hi")).where("lo <> hi")
    other = F.when(F.col("p") == F.col("lo"), F.col("hi")).otherwise(F.col("lo"))
    hits = place.join(index, "value").select("p", other.alias("o")).groupBy(F.col("p.no").alias("no")).agg(
        F.sort_array(F.collect_list(F.struct(
            F.col("p.start").alias("start"), F.col("o.no").alias("ref_no"), F.col("o.start").alias("ref")))
        ).alias("hits"))
    parsed = materialise(hits.mapInArrow(_parsed, f"no long, factors {FACTORS}").join(named, "no"))
    return parsed.join(copies, ["t1", "t2"], "full")


def remove_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, kept_text``: the words that no duplicate window covers, joined by one space.
    One row per row of ``docs``, NULL ids included."""
    found = parse(docs).select("t1", "t2", "factors", F.col("copies").isNotNull().alias("copied"))
    joined = text_keys(docs.select("doc_id", "text")).join(materialise(found), ["t1", "t2"], "left")
    return joined.select("doc_id", "text", "factors", "copied").mapInArrow(
        _kept, "doc_id long, n_words long, kept_text string")


def op4(docs: DataFrame) -> DataFrame:
    """Words removed and a digest of what is left, in the columns of the contract."""
    out = remove_duplicates(docs)
    left = F.when(F.col("kept_text") == "", 0).otherwise(
        F.length("kept_text") - F.length(F.replace("kept_text", F.lit(" "), F.lit(""))) + 1)
    return out.select("doc_id", "n_words", (F.col("n_words") - left).alias("n_removed"),
                      F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


SQL = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT rid, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
  FROM d, unnest(generate_series(1, len(w) - 34)) AS s(i)),
dup AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY h) AS c FROM windows) WHERE c > 1),
gone AS (SELECT DISTINCT rid, i + k AS i FROM dup, unnest(generate_series(0, 34)) AS s(k)),
left_over AS (
  SELECT d.rid, string_agg(w[p.i], ' ' ORDER BY p.i) AS kept, count(*) AS n
  FROM d, unnest(generate_series(1, len(w))) AS p(i)
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.rid = d.rid AND g.i = p.i) GROUP BY d.rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (rid)"""
