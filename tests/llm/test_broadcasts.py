"""What is sent to every executor is bounded by counted rows, not by the size of compressed files."""

from helpers import rows
from pyspark.sql import functions as F

from cohortry.llm import common, decontamination, urls
from cohortry.operators import materialise


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_table_beyond_the_bound_is_not_broadcast(spark):
    """Its files are small; before, Spark sent every copy of its rows through the driver."""
    table = materialise(spark.range(50).select((F.col("id") % 40).alias("id").cast("string").alias("k"), F.lit("v").alias("v")).distinct())
    big = spark.range(200).select(F.when(F.col("id") % 9 > 0, (F.col("id") % 45).cast("string")).alias("k"), "id")
    dealt = common.lookup_join(big, table, ["k"], 10)
    assert "BroadcastHashJoin" not in _plan(dealt) and "SortMergeJoin" in _plan(dealt)
    assert rows(dealt) == rows(common.lookup_join(big, table, ["k"], 1_000))


def test_many_starts_are_dealt_out_with_the_texts_that_have_some(spark, docs, sf_dir, monkeypatch):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    want = rows(decontamination.leaks(docs, bench))
    seen = []

    def watched(big, table, keys, broadcast_rows, spread=32, whole=None):
        seen.append((table.columns, big.count()))
        return common.lookup_join(big, table, keys, broadcast_rows, spread, whole)
    monkeypatch.setattr(decontamination, "lookup_join", watched)
    got = decontamination.leaks(docs, bench, broadcast_rows=5)
    assert rows(got) == want and len(want) > 0
    assert "BroadcastHashJoin" not in _plan(got)
    (narrow, all_docs), (wide, some) = seen
    assert "_starts" not in narrow and "_starts" in wide and all_docs == docs.count() and some < all_docs

def test_the_models_of_urls_are_not_broadcast(spark, monkeypatch):
    plans = []

    def stored(df):
        plans.append(_plan(df))
        return materialise(df)
    monkeypatch.setattr(urls, "materialise", stored)
    pages = spark.range(60).select(F.col("id").alias("page_id"), F.when(F.col("id") % 11 > 0, F.format_string(
        "https://h%d.%s/%s/%d", F.col("id") % 7, F.element_at(F.array(F.lit("org"), F.lit("com"), F.lit("net")), (F.col("id") % 3 + 1).cast("int")),
        F.element_at(F.array(F.lit("fr"), F.lit("de")), (F.col("id") % 2 + 1).cast("int")), F.col("id"))).alias("url"))
    out = urls.op13(pages)
    plans.append(_plan(out))
    assert out.count() == 60 and len(plans) == 4
    assert sum(p.count("SortMergeJoin") for p in plans) >= urls.ORDER + 2 and not any("BroadcastHashJoin" in p for p in plans)
