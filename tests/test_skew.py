"""Hot keys: detection, spreading, and equality with the plain way."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from cohortry.operators import (cluster, label_membership, large_groups, left_enrich,
                                materialise, score_cut, summarise, top_n, with_rank)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, some NULL keys, the rest spread out."""
    return spark.range(9000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, None)
         .otherwise((F.col("id") % 700).cast("string")).alias("k"),
        (F.col("id") % 97).cast("int").alias("n"),
        F.when(F.col("id") % 5 != 0, F.concat(F.lit("v"), F.col("id") % 41)).alias("v"))


def test_large_groups_are_found(spark, skewed):
    assert rows(large_groups(skewed, ["k"], 1000)) == [("hot", 3)]
    assert rows(large_groups(skewed, ["k"])) == []          # too few rows to matter
    assert rows(large_groups(skewed.limit(0), ["k"], 1)) == []
    null = skewed.where("k is null")
    assert rows(large_groups(null, ["k"], 50)) == [(None, -(-null.count() // 50))]


def test_summary_of_large_groups_is_the_same(spark, skewed):
    args = dict(metrics={"rows": F.count(F.lit(1)), "total": F.sum("n")},
                mode_cols={"top_v": "v", "top_n": "n"}, distinct_cols={"n": "ns", "v": "vs"},
                list_cols={"n": "n_list", "v": "v_list"})
    plain = summarise(skewed, ["k"], **args)
    for split_from in (1, 100, 10_000):
        split = summarise(skewed, ["k"], split_from=split_from, **args)
        assert split.columns == plain.columns
        assert rows(split) == rows(plain)


def test_any_number_of_groups_is_split(spark):
    """6,000 groups, each above the bound, and one below."""
    df = materialise(spark.range(60_005).select((F.col("id") % 6_001).alias("k"), (F.col("id") % 7).alias("v"))
                     .where("k < 6000 OR v = 0"))
    args = dict(metrics={"n": F.count(F.lit(1))}, mode_cols={"m": "v"}, distinct_cols={"v": "vs"}, list_cols={"v": "l"})
    assert large_groups(df, ["k"], 9).count() == 6_000
    assert rows(summarise(df, ["k"], split_from=9, **args)) == rows(summarise(df, ["k"], **args))


def test_large_groups_without_values(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", "x")], "k string, v string")
    args = dict(metrics={}, mode_cols={"m": "v"}, distinct_cols={"v": "n"}, list_cols={"v": "l"})
    assert rows(summarise(df, ["k"], split_from=1, **args)) == rows(summarise(df, ["k"], **args)) == [
        ("a", None, None, 0), ("b", "x", None, 1)]


def test_spread_join_matches_plain_join(spark, skewed):
    dim = spark.createDataFrame([("hot", 1), ("hot", 2), ("1", 3), (None, 4)], "k string, d int")
    plain = rows(skewed.join(dim, "k", "left"))
    hot = large_groups(skewed.where("k is not null"), ["k"], 1000)
    assert rows(left_enrich(skewed, dim, ["k"], spread_by=["id"])) == plain
    assert rows(left_enrich(skewed, dim, ["k"], spread_by=["id"], large=hot)) == plain


def partition_sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


@pytest.mark.parametrize("with_hot", [False, True])
def test_spread_join_really_spreads(spark, skewed, with_hot):
    """Without spreading, one join task gets the hot key (or all NULL keys)."""
    df = skewed if with_hot else skewed.withColumn("k", F.when(F.col("k") != "hot", F.col("k")))
    hot = large_groups(df.where("k is not null"), ["k"], 100) if with_hot else None
    dim = spark.range(700).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("d"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    before = {c: spark.conf.get(c) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        plain = max(partition_sizes(df.join(dim, "k", "left")))
        spread = max(partition_sizes(left_enrich(df, dim, ["k"], spread_by=["id"], large=hot)))
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert plain > 3000 and spread < 1300


def test_membership_never_multiplies(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "id string")
    one = spark.createDataFrame([("a",), ("a",), (None,)], "x string")
    two = spark.createDataFrame([("a",), ("b",), ("b",)], "x string")
    got = label_membership(df, "id", [("ONE", one), ("TWO", two)], "g", spread_by=["id"])
    assert rows(got) == [("a", "ONE"), ("b", "TWO"), ("c", None), (None, None)]
    assert rows(label_membership(df, "id", [], "g")) == [("a", None), ("b", None), ("c", None),
                                                         (None, None)]


@pytest.fixture(scope="module")
def scores(spark):
    """A third of all scores tied, a few missing."""
    return spark.range(5000).select(
        F.format_string("p%05d", "id").alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit(0.5)).when(F.col("id") % 100 == 1, None)
         .otherwise((F.col("id") * 7919 % 1000) / 1000.0).alias("s"))


@pytest.mark.parametrize("n", [1, 700, 2500, 4990, 5000, 6000])
def test_top_n_over_ranges_equals_sorting(scores, n):
    plain = [tuple(r) for r in scores.orderBy(F.col("s").desc_nulls_last(), "id").limit(n).collect()]
    assert rows(top_n(scores, "s", "id", n)) == sorted(plain, key=repr)
    want = sorted(((*r, i) for i, r in enumerate(plain, 1)), key=repr)
    assert rows(top_n(scores, "s", "id", n, rank="at", range_rows=100, buckets=3)) == want


@pytest.mark.parametrize("n", [0, 1, 3, 4, 6, 9, 12, 14, 20])
def test_odd_scores_are_ranked_as_spark_sorts_them(spark, n):
    odd = [float("nan"), float("inf"), 1e308, 1e-308, 5e-324, 0.0, -0.0, -1e308, float("-inf"), None, None, float("nan"), 1.0, 1.0]
    df = spark.createDataFrame([(f"p{i:02}", x) for i, x in enumerate(odd)], "id string, s double")
    plain = [r["id"] for r in df.orderBy(F.col("s").desc_nulls_last(), "id").limit(n).collect()]
    got = top_n(df, "s", "id", n, rank="at", range_rows=2, buckets=2).collect()
    assert [r["id"] for r in sorted(got, key=lambda r: r["at"])] == plain


@pytest.mark.parametrize("n", [1, 40, 2500, 4990, 5000])
def test_cut_keeps_few_rows_more(scores, n):
    cond, count = score_cut(scores, "s", n, slack=5, buckets=16)
    assert scores.where(cond).count() == count
    ties = scores.groupBy("s").count().agg(F.max("count")).first()[0]
    assert n <= count <= n + max(5, ties)


def test_ranges_of_ranks_are_bounded(spark, scores):
    ranked = with_rank(scores, "s", "id", range_rows=250)
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 5001))
    sizes = partition_sizes(scores.repartitionByRange(20, F.col("s").desc_nulls_last(), "id"))
    assert max(sizes) < 1000


def test_nobody_to_rank(scores):
    assert top_n(scores.limit(0), "s", "id", 5, rank="at").columns == ["id", "s", "at"]
    assert top_n(scores.limit(0), "s", "id", 5).count() == top_n(scores, "s", "id", 0).count() == 0


def test_top_n_keeps_exactly_n_of_equal_rows(spark):
    same = spark.range(1000).select(F.lit("x").alias("id"), F.lit(1.0).alias("s"))
    assert top_n(same, "s", "id", 10).count() == 10
    assert top_n(same, "s", "id", 10, range_rows=7).count() == 10


def test_interleaved_files_serve_filters_on_either_key(spark, tmp_path):
    from cohortry.sources import write_table
    df = spark.range(20_000).select(
        F.when(F.col("id") % 50 != 0, F.format_string("p%04d", F.pmod(F.xxhash64("id"), F.lit(500)))).alias("person"),
        F.date_add(F.lit("2025-01-01").cast("date"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(365)).cast("int")).alias("day"), "id")
    write_table(df, str(tmp_path / "z"), interleave_by=["person", "day"], partitions=64)
    write_table(df, str(tmp_path / "s"), cluster_by=["person", "day"], partitions=64)
    assert rows(spark.read.parquet(str(tmp_path / "z"))) == rows(df)

    def files(name, cond):
        return spark.read.parquet(str(tmp_path / name)).where(cond).select("_metadata.file_path").distinct().count()
    for cond in ("person = 'p0123'", "day = '2025-07-14'", "person is null"):
        assert files("z", cond) <= 24
    assert files("s", "day = '2025-07-14'") > 30


def test_cluster_splits_a_hot_key(spark, skewed):
    sizes = partition_sizes(cluster(skewed, ["k"], 8))
    assert sum(sizes) == 9000 and max(sizes) < 2500     # the hot key alone has 3000
