"""Streaming jobs over folders, run to completion with availableNow."""

from datetime import date, datetime

from helpers import rows
from pyspark.sql import functions as F

from cohortry import schemas
from cohortry.streaming import (daily_stream, enrich_stream, ingest_stream, load_history, load_stream, loaded_rows,
                                rejected_rows, upsert_stream, write_stream)

SCHEMA = schemas.struct([("id", "string"), ("ts", "timestamp"), ("v", "double")])


def put(spark, folder, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_each_file_is_read_once(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    put(spark, src, [("a", datetime(2025, 1, 1, 5), 1.0)])
    for expected in (1, 1, 2):
        if expected == 2:
            put(spark, src, [("b", datetime(2025, 1, 2), 2.0)])
        run(write_stream(ingest_stream(spark, src, SCHEMA, "parquet"), out, ckpt))
        assert spark.read.schema(SCHEMA).parquet(out).count() == expected


def test_csv_ingest_with_glob(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.tsv").write_text("a\t2025-01-01 00:00:00\t1\n")
    (tmp_path / "src" / "b.txt").write_text("junk\n")
    stream = ingest_stream(spark, str(tmp_path / "src"), SCHEMA, "csv", glob="*.tsv", sep="\t")
    run(write_stream(stream, str(tmp_path / "out"), str(tmp_path / "ckpt")))
    assert spark.read.schema(SCHEMA).parquet(str(tmp_path / "out")).count() == 1


def test_daily_totals_accept_late_rows_within_the_delay(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))

    def step(*data):
        put(spark, src, data)
        daily = daily_stream(ingest_stream(spark, src, SCHEMA, "parquet"), "ts", "id", "v")
        run(write_stream(daily, out, ckpt))
    step(("a", datetime(2025, 1, 1, 5), 1.0), ("a", datetime(2025, 1, 2, 5), 2.0))
    step(("a", datetime(2025, 1, 1, 6), 10.0))          # a day late: still counted
    step(("a", datetime(2025, 1, 9, 6), 5.0))           # moves the watermark past both days
    step(("a", datetime(2025, 1, 1, 7), 100.0))         # too late: dropped
    step(("a", datetime(2025, 1, 20), 1.0))
    got = spark.read.parquet(out).select("day", "id", "transaction_count", "total_amount")
    assert rows(got) == [(date(2025, 1, 1), "a", 2, 11.0), (date(2025, 1, 2), "a", 1, 2.0),
                         (date(2025, 1, 9), "a", 1, 5.0)]


def test_load_keeps_rejects_and_history(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    schema = schemas.struct([("id", "string"), ("n", "int")])
    (tmp_path / "src").mkdir()
    for k, text in enumerate(["a\t1\nb\tx\n", "c\t3\n\nd\n", "e\t5\n", "f\tno\n"]):
        (tmp_path / "src" / f"f{k}.tsv").write_text(text)
        if k % 2:
            for _ in range(2):  # a run that finds nothing new changes nothing
                run(load_stream(spark, src, schema, out, ckpt, glob="*.tsv", max_files=1))
    assert rows(loaded_rows(spark, out, schema)) == [("a", 1), ("c", 3), ("e", 5)]
    bad = rejected_rows(spark, out).collect()
    assert sorted((r["_file"][-6:], r["record"]) for r in bad) == [("f0.tsv", "b\tx"), ("f1.tsv", "d"), ("f3.tsv", "f\tno")]
    history = {r["file"][-6:]: (r["row_count"], r["error_count"], r["status"]) for r in load_history(spark, out).collect()}
    assert history == {"f0.tsv": (1, 1, "PARTIALLY_LOADED"), "f1.tsv": (1, 1, "PARTIALLY_LOADED"), "f2.tsv": (1, 0, "LOADED"),
                       "f3.tsv": (0, 1, "LOAD_FAILED")}


def test_upsert_over_batches(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    for data in ([("a", datetime(2025, 1, 1), 1.0), ("b", datetime(2025, 1, 1), 2.0)],
                 [("a", datetime(2025, 1, 2), 3.0), ("a", datetime(2025, 1, 3), 4.0)],
                 [("a", datetime(2024, 12, 31), 9.0), ("b", datetime(2024, 12, 31), 9.0)]):  # older, and late
        put(spark, src, data)
        stream = ingest_stream(spark, src, SCHEMA, "parquet") \
            .withColumn("shard", F.when(F.col("id") == "a", "s1").otherwise("s2"))
        run(upsert_stream(stream, out, ["id"], "shard", ckpt, order_by="ts"))
    got = spark.read.parquet(out).select("id", "v")
    assert rows(got) == [("a", 4.0), ("b", 2.0)]


def test_stream_enrichment(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    put(spark, src, [("a", datetime(2025, 1, 1), 1.0), ("z", datetime(2025, 1, 1), 2.0)])
    dim = spark.createDataFrame([("a", "X")], "id string, name string")
    rich = enrich_stream(ingest_stream(spark, src, SCHEMA, "parquet"), [(dim, ["id"])])
    run(write_stream(rich.select("id", "name"), out, ckpt))
    assert rows(spark.read.schema("id string, name string").parquet(out)) == [("a", "X"), ("z", None)]
