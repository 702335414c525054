"""Ranked extraction and physical ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .materialise import materialise
from .packing import free_name, shuffled

#: Intervals a round of the search counts, and rows of one range of ranks, which one task sorts.
BUCKETS, RANGE_ROWS = 4096, 1_000_000


def _kind(value: Column) -> Column:
    """The groups of scores in rank order: NaN, infinity, numbers, minus infinity, NULL."""
    return (F.when(value.isNull(), 4).when(F.isnan(value), 0).when(value == float("inf"), 1)
            .when(value == float("-inf"), 3).otherwise(2))


def score_cut(df: DataFrame, score: str, n: int, slack: int = RANGE_ROWS, buckets: int = BUCKETS) -> tuple[Column, int]:
    """(condition, rows): the best scores that hold the ``n`` best rows, with all rows of the last score.

    A selection by histograms.  The range of the scores is counted in ``buckets`` equal intervals, the one in
    which the ``n``-th row falls is counted again from its least to its highest score, and so on until the
    scores above and in it are at most ``n + slack`` rows or it is a single score.  A round is one aggregate
    with a bounded result, and needs the score column alone; no row is moved.  Scores are compared as doubles.
    """
    value = F.col(score).cast("double")
    whole = df.select(value.alias("v"), _kind(value).alias("k"))
    kinds = {r["k"]: r for r in whole.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()}  # 5 rows at most
    above = 0
    for k in sorted(kinds):
        if above + kinds[k]["n"] >= n and n > 0:
            break
        above += kinds[k]["n"]
    else:
        return F.lit(n > 0), above if n > 0 else 0
    inside, low, high = kinds[k]["n"], kinds[k]["low"], kinds[k]["high"]
    if k == 2:
        while low < high and above + inside > n + slack:
            # halves keep the width finite; each step is monotone, so buckets follow the scores
            at = F.least(F.lit(buckets - 1), F.floor((F.col("v") / 2 - low / 2) / (high / 2 - low / 2) * buckets))
            counts = whole.where((F.col("k") == 2) & F.col("v").between(low, high)).groupBy(at.alias("b")).agg(
                F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()
            for r in sorted(counts, key=lambda r: -r["b"]):
                inside, low, high = r["n"], r["low"], r["high"]
                if above + inside >= n:
                    break
                above += inside
            if len(counts) == 1:  # neighbouring doubles that the division does not tell apart
                break
    kind = _kind(value)
    return (kind < k) | ((kind == k) & (value >= low) if k == 2 else kind == k), above + inside


def with_rank(df: DataFrame, score: str, tiebreak: str, rank: str = "rank", rows: int | None = None,
              range_rows: int = RANGE_ROWS) -> DataFrame:
    """``df`` with the place of each row by highest score, ties to the lowest ``tiebreak``, from 1 without gaps.

    NULL scores come last, NULL tiebreaks first; rows equal in both go by their other columns.  Rows are
    range-partitioned in that order into ranges of about ``range_rows``, sorted and stored with their place in
    the range; a rank is this place plus the rows of the ranges before, which are counted from the stored table.
    """
    rows = df.count() if rows is None else rows
    rest = F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if not t.startswith("map")])
    order = [F.col(score).desc_nulls_last(), F.col(tiebreak).asc_nulls_first(), rest]
    placed = materialise(df.repartitionByRange(max(1, -(-rows // range_rows)), *order).sortWithinPartitions(*order)
                         .withColumn("_at", F.monotonically_increasing_id()))  # range in the high bits, place below
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # one row a range, as many as the rows asked for allow
    return placed.join(F.broadcast(sizes), part == F.col("_part")).withColumn(
        rank, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_at", "_part", "_before")


def top_n(df: DataFrame, score: str, tiebreak: str, n: int, rank: str | None = None,
          range_rows: int = RANGE_ROWS, buckets: int = BUCKETS) -> DataFrame:
    """The ``n`` rows with the highest score, ties to the lowest ``tiebreak``; NULL scores last.  ``rank`` names a
    column for their places.

    One way for every ``n``: the rows are stored, a search over their scores alone drops the others, and only
    the rest is ranked.  No range of ranks is larger than a task takes, even if a third of all rows share a score.
    """
    stored = materialise(df)
    inside, rows = score_cut(stored, score, n, range_rows, buckets)
    name = rank or "_rank"
    best = with_rank(stored.where(inside), score, tiebreak, name, rows, range_rows).where(F.col(name) <= n)
    return best if rank else best.drop(name)


def cluster(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-clusters rows by ``keys`` for writing.

    A hash of the row extends the range key, so one hot key spreads over neighbouring files
    instead of ending in a single task.
    """
    return _ranged(df, keys, partitions)


def _ranged(df: DataFrame, keys: Sequence[str], partitions: int | None, first: Column | None = None) -> DataFrame:
    """Ranges of (``first``, or else ``keys``, hash of the row), sorted by ``first`` and ``keys`` in each."""
    flat = [c for c, t in df.dtypes if not t.startswith("map")]
    row, place = free_name(df, "_row"), free_name(df, "_place")
    extra = {row: F.xxhash64(*flat)} if first is None else {place: first, row: F.xxhash64(*flat)}
    columns = [*(keys if first is None else [place]), row]
    order = keys if first is None else [place, *keys]

    def move(rows):
        ranged = rows.repartitionByRange(partitions, *columns) if partitions else rows.repartitionByRange(*columns)
        return ranged.sortWithinPartitions(*order)
    return shuffled(df, move, keys, **extra)


def _place_among(value: Column, bounds: Sequence, low: int = 0, high: int | None = None) -> Column:
    """Number of ``bounds`` (ascending) up to ``value``, by halving; NULL comes before them all."""
    high = len(bounds) if high is None else high
    if low == high:
        return F.lit(low)
    mid = (low + high) // 2
    return F.when(value >= F.lit(bounds[mid]), _place_among(value, bounds, mid + 1, high)).otherwise(
        _place_among(value, bounds, low, mid))


def interleave(df: DataFrame, keys: Sequence[str], partitions: int | None = None, bits: int = 6,
               sample_rows: int = 20_000) -> DataFrame:
    """Clusters rows for filters on any one of ``keys``: a range key of their interleaved bits (Z-order).

    Each key counts by its place among 2^``bits`` ranges of about equal rows, whose bounds come from
    ``sample_rows`` rows, those of least hash; they shape the files, not the rows.  The bits of all places in turn
    make one number, so a file holds neighbours in every key.  A hash of the row splits hot keys, as in
    :func:`cluster`.
    """
    flat = [c for c, t in df.dtypes if not t.startswith("map")]
    row = F.xxhash64(*flat)
    sample = df.select(*keys, row.alias("_row")).orderBy("_row").limit(sample_rows).collect()
    places = []
    for k in keys:
        seen = sorted(r[k] for r in sample if r[k] is not None)
        bounds = sorted({seen[len(seen) * i // 2**bits] for i in range(1, 2**bits)}) if seen else []
        places.append(_place_among(F.col(k), bounds).cast("bigint"))
    z = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, place in enumerate(places):
            one = F.shiftright(place, bit).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(one, bit * len(keys) + len(keys) - 1 - i))
    return _ranged(df, keys, partitions, z)
