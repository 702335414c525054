"""Figures that must not grow with the tables: rows a task, states, stored bytes."""

from helpers import rows
from pyspark.sql import functions as F

from cohortry import schemas
from cohortry.operators import cluster, summarise
from cohortry.plans import build_fact, daily_summary
from cohortry.sources import files, tables
from cohortry.streaming import ingest_stream, jobs, upsert_stream
from cohortry.workload import adapters


def test_few_people_of_the_spine_go_into_a_task(spark, tmp_path, monkeypatch):
    """One file of one row group, with missing and repeated keys."""
    key = F.when(F.col("id") % 4 != 0, F.col("id") % 500).cast("bigint")
    spark.range(2_000).select(
        key.alias("c_custkey"), F.format_string("n%d", "id").alias("c_name"), (F.col("id") % 3).alias("c_nationkey"),
        F.lit("BUILDING").alias("c_mktsegment"), (F.col("id") * 1.5).alias("c_acctbal")) \
        .coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    spark.range(3).select(F.col("id").alias("n_nationkey"), F.format_string("N%d", "id").alias("n_name")) \
        .coalesce(1).write.parquet(str(tmp_path / "nation.parquet"))
    for name, column in {"part": "p_partkey", "region": "r_regionkey"}.items():  # named inside other words of the SQL
        spark.range(1).select(F.col("id").alias(column)).write.parquet(str(tmp_path / f"{name}.parquet"))
    monkeypatch.setattr(adapters, "SPINE_ROWS", 50)
    d = adapters.Domain(spark, str(tmp_path))
    spine = d.spine
    sizes = [r["count"] for r in spine.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 2_000 and max(sizes) < 110
    plain = d.sql(adapters.select_sql("spine"))
    some = ["individual_id", "lu_a_adat", "combined_age_1", "stat_abbr"]
    assert rows(spine.select(*some)) == rows(plain.select(*some))


def test_sources_are_dealt_by_their_rows(spark):
    df = spark.range(0, 1_000, 1, 2)
    assert files.spread(df, "id", task_rows=20).rdd.getNumPartitions() == 50
    assert files.spread(df, "id", task_rows=900).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 1_000, 1, 64)
    assert files.spread(many, "id", task_rows=100).rdd.getNumPartitions() == 64


def test_aggregates_of_large_groups_do_not_grow_with_the_fields(spark):
    """One list and one extreme for each type; before, one for each field."""
    names = [f"c{i}" for i in range(12)]
    df = spark.range(40).select((F.col("id") % 2).alias("k"), *[F.format_string(f"{n}-%d", F.col("id") % (i + 1)).alias(n)
                                                                 for i, n in enumerate(names)])
    args = dict(metrics={"n": F.count(F.lit(1))}, mode_cols={f"m_{n}": n for n in names[6:]},
                distinct_cols={n: f"n_{n}" for n in names}, list_cols={n: f"l_{n}" for n in names})
    split = summarise(df, ["k"], split_from=20, **args)
    assert rows(split) == rows(summarise(df, ["k"], **args))
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    part = plan[plan.rindex("Join"):]
    assert part.count("collect_list(") <= 3 and part.count("min(") + part.count("min_by(") <= 2


def test_a_batch_is_computed_once(spark, tmp_path):
    """A batch of a stream that is used again would run its plan and state again."""
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    ran = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            ran.add(b.num_rows)
            yield b
    for first in (0, 3):
        spark.range(first, 5).select(F.col("id").cast("string").alias("k"), F.lit("p").alias("p")).coalesce(1) \
            .write.mode("append").parquet(src)
        stream = ingest_stream(spark, src, schemas.struct([("k", "string"), ("p", "string")]), "parquet") \
            .mapInArrow(count, "k string, p string")
        query = upsert_stream(stream, out, ["k"], "p", ckpt)
        query.awaitTermination(120)
        assert query.exception() is None
    assert ran.value == 7 and spark.read.parquet(out).count() == 5
    assert not list(tmp_path.glob("batch-*"))


def test_state_is_kept_on_disk(spark, tmp_path):
    """A checkpoint begun with another store goes on with it, and the session is left as it was."""
    src = str(tmp_path / "src")

    def deliver(first, last):
        spark.range(first, last).select((F.col("id") % 2).cast("string").alias("k"), F.lit("p").alias("p")).coalesce(1) \
            .write.mode("append").parquet(src)

    def counted(name):
        out, ckpt = str(tmp_path / name), str(tmp_path / f"{name}-ckpt")
        stream = ingest_stream(spark, src, schemas.struct([("k", "string"), ("p", "string")]), "parquet") \
            .groupBy("k", "p").count()
        query = upsert_stream(stream, out, ["k"], "p", ckpt, mode="update")
        query.awaitTermination(120)
        assert query.exception() is None and spark.conf.get(jobs.STATE_STORE, None) is None
        return rows(spark.read.parquet(out).select("k", "count")), (tmp_path / f"{name}-ckpt/offsets/0").read_text()
    deliver(0, 4)
    spark.conf.set(jobs.STATE_STORE, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        upsert_stream(ingest_stream(spark, src, schemas.struct([("k", "string"), ("p", "string")]), "parquet")
                      .groupBy("k", "p").count(), str(tmp_path / "old"), ["k"], "p", str(tmp_path / "old-ckpt"),
                      mode="update").awaitTermination(120)
    finally:
        spark.conf.unset(jobs.STATE_STORE)
    counted("new")
    deliver(4, 7)
    for name, store in (("old", "HDFSBacked"), ("new", "RocksDB")):
        got, offsets = counted(name)
        assert got == [("0", 4), ("1", 3)] and f"{store}StateStoreProvider" in offsets


def _ranges(df, *keys):
    """Least and greatest key of each partition."""
    key = F.struct(*keys)
    return sorted((r["a"], r["b"]) for r in df.groupBy(F.spark_partition_id().alias("p")).agg(
        F.min(key).alias("a"), F.max(key).alias("b")).collect())


def test_groups_come_in_ranges_with_one_shuffle(spark):
    """Missing and repeated keys, and one group that is aggregated value by value."""
    df = spark.range(600).select(
        F.when(F.col("id") < 100, 7).otherwise(F.col("id") % 9).cast("int").alias("d"),
        F.when(F.col("id") < 100, "hot").when(F.col("id") % 11 > 0, F.format_string("p%d", F.col("id") % 70)).alias("k"),
        F.format_string("v%d", F.col("id") % 5).alias("v"))
    args = dict(metrics={"n": F.count(F.lit(1))}, mode_cols={"m": "v"}, distinct_cols={"v": "vs"}, list_cols={"v": "l"})
    got = summarise(df, ["d", "k"], split_from=100, ranged=True, **args)
    assert rows(got) == rows(summarise(df, ["d", "k"], **args))
    assert got.where("k = 'hot'").first()["n"] == 100
    ranged = summarise(df.where("id >= 100"), ["d", "k"], split_from=100, ranged=True, **args)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ends = _ranges(ranged.where("k is not null"), "d", "k")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(ends) > 1 and all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_a_build_clusters_the_wide_rows_once(spark, tmp_path, monkeypatch):
    """The summary of a full run comes in the order of its files, without a shuffle of its own."""
    clustered = []
    monkeypatch.setattr(tables, "cluster", lambda df, keys, n=None: clustered.append(keys) or cluster(df, keys, n))
    n = spark.range(400).withColumn("day", F.expr("date_add(date'2001-01-20', cast(id % 25 as int))"))
    tx = n.select(
        F.format_string("t%d", F.col("id") % 390).alias("txid"), F.format_string("m%d", F.col("id") % 13).alias("mtid"),
        F.when(F.col("id") % 7 > 0, F.format_string("c%d", F.col("id") % 30)).alias("membccid"),
        F.col("day").alias("trans_date"), F.lit("12:00:00").alias("trans_time"), F.lit("UTC").alias("trans_time_zone"),
        F.col("id").cast("decimal(18,2)").alias("trans_amount"), F.col("day").alias("delivery_date"))
    card = spark.range(30).selectExpr("'c' || id AS membccid", "if(id % 5 > 0, 'p' || id % 12, null) AS individual_id",
                                      "'K' AS card_type", "'z' || id AS card_zip", "'A' AS areaid")
    shop = spark.range(11).selectExpr(
        "'m' || id AS mtid", "'shop ' || id AS merch_desc", "'1' AS mcc", "'C' AS merch_city", "'S' AS merch_state",
        "'0' AS merch_zip", "'US' AS merch_country")
    tags = spark.range(13).selectExpr("'m' || id AS mtid", "cast(id AS int) AS store_id", "1 AS brand_id",
                                      "'ONLINE' AS channel", "'l' || id % 3 AS locationid")
    taxonomy = spark.range(13).selectExpr(
        "cast(id AS int) AS store_id", "1 AS brand_id", "'s' || id AS store_name", "'b' AS brand_name", "'t' AS store_type",
        "'D' AS brand_type", "1 AS brand_tagging_classification")
    place = spark.range(3).selectExpr("'l' || id AS locationid", "'a' AS address", "'c' AS city", "'s' AS state",
                                      "'0' AS zip", "'US' AS country", "'1990-01-01' AS est_open_date",
                                      "cast(null AS string) AS est_close_date")
    build_fact(spark, {"transaction": tx, "card": card, "merchant": shop, "brand_tagging": tags, "brand_taxonomy": taxonomy,
                       "brand_location": place}, str(tmp_path))
    assert len(clustered) == 1
    stored = spark.read.parquet(str(tmp_path / "daily_summary")).drop("trans_month")
    assert rows(stored) == rows(daily_summary(spark.read.parquet(str(tmp_path / "fact")), split_from=None))
    key = F.struct("trans_date", "individual_id")
    ends = sorted((r["a"], r["b"]) for r in stored.groupBy(F.col("_metadata.file_path")).agg(
        F.min(key).alias("a"), F.max(key).alias("b")).collect())
    assert len(ends) > 1 and all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
