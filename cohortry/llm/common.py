"""Helpers shared by the text operators."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# functions that run in tasks travel with the job, wherever the executors' working folder is
cloudpickle.register_pickle_by_value(sys.modules[__package__])

GAP = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Maximal runs of characters other than space and U+0009 to U+000D; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def ngrams(hashes: Column, size: Column, n: int) -> Column:
    """64-bit hashes of every ``n`` consecutive entries; ``size`` is the length of ``hashes``."""
    return F.when(size >= n, F.transform(
        F.slice(hashes, F.lit(1), F.greatest(size - (n - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get(hashes, i + k) for k in range(1, n)]))
    ).otherwise(F.array().cast("array<bigint>"))


def small(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than that."""
    return df.limit(rows + 1).count() <= rows


def lookup_join(big: DataFrame, table: DataFrame, keys: list[str], broadcast_rows: int,
                spread: int = 32, whole: DataFrame | None = None) -> DataFrame:
    """Left join of ``big`` with a table of one row per key, NULL keys equal.

    The table is broadcast after a count shows at most ``broadcast_rows`` rows (of ``whole`` where its
    rows hold arrays).  Beyond that both sides are dealt out by key and a salt, so a key with a third of
    the rows meets in ``spread`` tasks.  These are merged: Spark would judge by the size of files, which hold
    repeated values in a fraction of what their rows take, and send ``spread`` copies through the driver.
    """
    def on(a, b, names):
        cond = F.lit(True)
        for k in names:
            cond = cond & a[k].eqNullSafe(b[f"_k_{k}"])
        return cond
    renamed = table.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    drop = [f"_k_{k}" for k in keys]
    if small(table if whole is None else whole, broadcast_rows):
        right = F.broadcast(renamed)
        return big.join(right, on(big, right, keys), "left").drop(*drop)
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]),
                                          F.lit(spread)).cast("int"))
    right = renamed.withColumn("_k__salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))).hint("merge")
    return left.join(right, on(left, right, [*keys, "_salt"]), "left").drop("_salt", "_k__salt", *drop)


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
