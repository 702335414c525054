"""Set algebra on id lists (one id column each; results hold every id once) and overlaps of many cohorts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .materialise import materialise


def cohort_union(*ids: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, ids).distinct()


def cohort_intersect(*ids: DataFrame) -> DataFrame:
    return reduce(DataFrame.intersect, ids)


def cohort_except(first: DataFrame, *others: DataFrame) -> DataFrame:
    return reduce(DataFrame.subtract, others, first)


def cohort_bitmaps(members: DataFrame, cohort: str = "cohort", id_col: str = "individual_id") -> DataFrame:
    """``cohort, bucket, ids``: every cohort as exact bitmaps over numbered ids, 32,768 ids a bucket.

    Ids are numbered where they are stored, so a task's ids are neighbours and share buckets.  Repeated members
    count once, NULL ids and cohorts are left out.
    """
    known = members.where(F.col(cohort).isNotNull() & F.col(id_col).isNotNull()).select(cohort, id_col)
    numbers = materialise(known.select(id_col).distinct().withColumn("_n", F.monotonically_increasing_id() + 1))
    return known.join(numbers, id_col).groupBy(F.col(cohort).alias("cohort"), F.expr("bitmap_bucket_number(_n)").alias("bucket")
                                               ).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_n))").alias("ids"))


def cohort_overlap(members: DataFrame, cohort: str = "cohort", id_col: str = "individual_id") -> DataFrame:
    """``cohort, other, ids, other_ids, both, share``: size and overlap of every two cohorts, each pair once.

    Members are read once for all pairs.  Cohorts meet bucket by bucket as bitmaps, a fixed 4 KiB each, not as
    ids, so the work grows with cohorts times buckets, and one large cohort is many small rows.
    """
    maps = materialise(cohort_bitmaps(members, cohort, id_col))
    sizes = maps.groupBy("cohort").agg(F.sum(F.expr("bitmap_count(ids)")).alias("n"))
    other = maps.select(F.col("cohort").alias("other"), "bucket", F.col("ids").alias("_ids"))
    met = maps.join(other, "bucket").where("cohort < other").select(
        "cohort", "other", "bucket", F.explode(F.array("ids", "_ids")).alias("ids"))
    both = met.groupBy("cohort", "other", "bucket").agg(F.expr("bitmap_and_agg(ids)").alias("ids")).groupBy(
        "cohort", "other").agg(F.sum(F.expr("bitmap_count(ids)")).alias("both"))
    # one row a cohort and, as asked for, one a pair
    pairs = sizes.join(sizes.select(F.col("cohort").alias("other"), F.col("n").alias("other_ids")), F.col("cohort") < F.col("other"))
    return pairs.join(both, ["cohort", "other"], "left").select(
        "cohort", "other", F.col("n").alias("ids"), "other_ids", F.coalesce("both", F.lit(0)).alias("both"),
        (F.coalesce("both", F.lit(0)) / F.least("n", "other_ids")).alias("share"))
