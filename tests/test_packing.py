"""Texts are one value while wide rows are shuffled, and come back as they were."""

from helpers import rows
from pyspark.sql import functions as F

from cohortry.operators import cluster, interleave, summarise
from cohortry.operators.packing import pack, unpack

ODD = [(1, "a", "b"), (2, None, "b"), (2, None, "b"), (3, "", None), (4, None, None), (5, "", ""), (6, "a\x1fb", "\x1e2"),
       (7, "\x1e", "\x1f"), (8, "\x1e0\x1e1", "\x1e3FF"), (9, "\x1e2", None), (None, "é\n\x00", " "), (10, "a", "\x1fb"),
       (11, "a\x1f", "b")]


def odd(spark):
    """Also bytes that are no text, cut in the middle of a character."""
    df = spark.createDataFrame(ODD, "k int, a string, b string").withColumn("day", F.expr("date_add(date'2001-01-01', k % 3)"))
    cut = df.limit(1).select(F.lit(12).alias("k"), F.expr("cast(unhex('FFC3') as string)").alias("a"),
                             F.expr("cast(unhex('A9') as string)").alias("b"), "day")
    return df.unionByName(cut)


def as_bytes(df):
    return rows(df.select(*[F.hex(c).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes]))


def test_packed_texts_come_back(spark):
    df = odd(spark)
    packed = df.withColumn("p", pack([F.col("a"), F.col("b")]))
    back = packed.select("k", unpack(F.col("p"))[0].alias("a"), unpack(F.col("p"))[1].alias("b"), "day")
    assert as_bytes(back) == as_bytes(df)
    assert packed.where("p is null").count() == 0
    assert packed.select(F.hex("p")).distinct().count() == df.select(F.hex("a"), F.hex("b")).distinct().count()


def test_clustered_rows_are_the_same(spark):
    df = odd(spark).withColumns({"_row": F.lit("mine"), "_texts": F.lit("too"), "_each": F.lit(1)})
    for out in (cluster(df, ["day", "k"]), cluster(df, ["a"], 3), interleave(df, ["day", "k"], 4)):
        assert out.dtypes == df.dtypes and as_bytes(out) == as_bytes(df)


def test_wide_rows_are_shuffled_as_one_text(spark):
    """Before, each text was a column of the shuffled row."""
    names = [f"c{i}" for i in range(12)]
    df = spark.range(300).select((F.col("id") % 90).alias("k"), *[F.format_string(f"{n}-%d", F.col("id")).alias(n) for n in names])
    few = summarise(df, ["k"], {"n": F.count(F.lit(1))}, distinct_cols={n: f"n_{n}" for n in names}, split_from=100)
    for out in (cluster(df, ["k"]), interleave(df, ["k"]), few):
        plan = out._jdf.queryExecution().optimizedPlan()
        found = []

        def walk(node):
            if "RepartitionByExpression" in node.nodeName():
                found.append(node.output().size())
            for i in range(node.children().size()):
                walk(node.children().apply(i))
        walk(plan)
        assert found and max(found) <= 4


def test_summaries_of_odd_texts(spark):
    df = odd(spark).where("k is null or k < 12")
    args = dict(metrics={"n": F.count(F.lit(1))}, distinct_cols={"a": "as_", "b": "bs"}, list_cols={"a": "la", "k": "lk"})
    got = rows(summarise(df, ["day"], **args))
    assert got == rows(summarise(df, ["day"], split_from=100, **args)) == rows(summarise(df, ["day"], split_from=1, **args))
    plain = rows(df.groupBy("day").agg(F.count_distinct("a"), F.count_distinct("b")))
    assert [(r[0], *r[4:]) for r in got] == plain
    assert rows(summarise(df, ["day"], {"n": F.count(F.lit(1))}, list_cols={"k": "l"}).select("n")) == rows(
        df.groupBy("day").count().select("count"))
