"""Structured Streaming forms of ingest, upsert, daily summary and enrichment.

Every job takes its checkpoint folder from the caller (shared storage on a cluster).  With
``trigger_once`` a job works through everything available and stops; otherwise it runs on.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cohortry.functions.scalars import as_col
from cohortry.operators import left_enrich, merge_partitions, stored_once
from cohortry.sources.files import REJECT, load_report


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """A query started here keeps its state in RocksDB, so that the heap does not have to hold every day and person
    of a large delivery.  A store the session names is left, as is that of a checkpoint begun with another."""
    if spark.conf.get(STATE_STORE, None):
        yield
        return
    spark.conf.set(STATE_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(STATE_STORE)


def _trigger(writer, trigger_once: bool):
    return writer.trigger(availableNow=True) if trigger_once else \
        writer.trigger(processingTime="1 minute")


def ingest_stream(spark: SparkSession, src: str, schema: T.StructType, fmt: str = "csv",
                  glob: str | None = None, max_files: int | None = None,
                  **options) -> DataFrame:
    """Stream of the files in a folder, each read once however often the job is restarted."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(src)


def load_stream(spark: SparkSession, src: str, schema: T.StructType, out: str, checkpoint: str, sep: str = "\t",
                header: bool = False, glob: str | None = None, max_files: int | None = None,
                trigger_once: bool = True) -> StreamingQuery:
    """Loads delimited files as they arrive, keeping rejected rows and a history of the files.

    One pass writes both: ``out/rows`` holds every row, rejected ones in folders of their own with their text
    and file.  ``out/history`` has a row for each file, from the rows stored.  Each batch writes to its own
    folder and replaces it if it runs again, so nothing is loaded twice.  See :func:`loaded_rows`,
    :func:`rejected_rows` and :func:`load_history`.
    """
    wide = T.StructType([*schema.fields, T.StructField(REJECT, T.StringType())])
    stream = ingest_stream(spark, src, wide, "csv", glob, max_files, sep=sep, header=header, quote='"', escape='"',
                           dateFormat="yyyy-MM-dd", mode="PERMISSIVE", columnNameOfCorruptRecord=REJECT)
    # see read_tolerant: ties the reject text to all columns, so that whole rows are judged
    whole = F.hash(*schema.fieldNames()) >= F.lit(-2**31)
    rows = stream.select(*schema.fieldNames(), F.when(whole, F.col(REJECT)).alias(REJECT),
                         F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))

    def store(batch: DataFrame, batch_id: int) -> None:
        at = f"{out}/rows/batch={batch_id}"
        placed = batch.withColumn("_place", F.struct("_block", F.monotonically_increasing_id().alias("row"))).drop("_block")
        placed.withColumn("rejected", F.col(REJECT).isNotNull()).write.mode("overwrite").partitionBy("rejected").parquet(at)
        kept = batch.sparkSession.read.schema(f"{REJECT} string, _file string, _place struct<_block:bigint,row:bigint>").parquet(at)
        load_report(kept).withColumn("loaded_at", F.current_timestamp()).coalesce(1).write.mode("overwrite").parquet(
            f"{out}/history/batch={batch_id}")
    return _trigger(rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint), trigger_once).start()


def loaded_rows(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """Good rows that :func:`load_stream` stored."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("rejected", T.BooleanType())])).parquet(f"{out}/rows")
    return rows.where("NOT rejected").select(*schema.fieldNames())


def rejected_rows(spark: SparkSession, out: str) -> DataFrame:
    """Rejected rows that :func:`load_stream` stored: file and text."""
    rows = spark.read.schema(f"{REJECT} string, _file string, rejected boolean").parquet(f"{out}/rows")
    return rows.where("rejected").select("_file", F.col(REJECT).alias("record"))


def load_history(spark: SparkSession, out: str) -> DataFrame:
    """One row for each file :func:`load_stream` has read, as ``load_report`` gives it, and when."""
    return spark.read.parquet(f"{out}/history").drop("batch")


def write_stream(stream: DataFrame, path: str, checkpoint: str, mode: str = "append",
                 partition_by: Sequence[str] = (), trigger_once: bool = True) -> StreamingQuery:
    """Appends a stream to a Parquet table, exactly once."""
    writer = stream.writeStream.format("parquet").outputMode(mode) \
        .option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _trigger(writer, trigger_once).start()


def upsert_stream(stream: DataFrame, target: str, keys: Sequence[str], partition_col: str,
                  checkpoint: str, order_by: str | None = None,
                  trigger_once: bool = True, mode: str = "append") -> StreamingQuery:
    """Upserts every micro-batch into a partitioned Parquet table.

    Re-running a batch after a failure gives the same table.  With ``order_by`` the row of the highest
    value stays, whether it is in the batch or in the table, so late rows replace nothing newer;
    without it a key twice in a batch is an error.  ``mode="update"`` suits aggregates, whose changed
    rows replace the old.
    """
    def merge(batch: DataFrame, _batch_id: int) -> None:
        with stored_once(batch) as rows:  # every use of the batch itself would run the stream's plan and state again
            if not rows.isEmpty():
                merge_partitions(rows.sparkSession, target, rows, keys, partition_col, order_by=order_by)
    with _state_on_disk(stream.sparkSession):
        return _trigger(stream.writeStream.outputMode(mode).foreachBatch(merge)
                        .option("checkpointLocation", checkpoint), trigger_once).start()


def daily_stream(stream: DataFrame, ts: str, id_col: str, value: str,
                 delay: str = "2 days") -> DataFrame:
    """Daily totals per id; a day is final once the watermark has passed it.

    Rows up to ``delay`` late still count, unlike a slice by highest date.  Days are UTC days, and
    times without a zone are taken as UTC, whatever the session's time zone.
    """
    when = as_col(ts)
    if isinstance(stream.schema[ts].dataType, T.TimestampNTZType):
        when = F.concat(when.cast("string"), F.lit("Z")).cast("timestamp")
    day = F.date_from_unix_date(F.floor(F.unix_seconds("_w.start") / 86_400).cast("int"))
    return (stream.withColumn(ts, when).withWatermark(ts, delay)
            .groupBy(F.window(ts, "1 day").alias("_w"), id_col)
            .agg(F.count(F.lit(1)).alias("transaction_count"), F.sum(value).alias("total_amount"),
                 F.min(value).alias("min_amount"), F.max(value).alias("max_amount"))
            .select(day.alias("day"), id_col, "transaction_count",
                    "total_amount", "min_amount", "max_amount"))


def enrich_stream(stream: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Stream with static dimensions looked up: ``[(dimension, key columns), ...]``.

    Rows with a NULL key match nothing; they are dealt out by a hash of the row instead of meeting in one task.
    """
    for dim, on in dims:
        stream = left_enrich(stream, dim, list(on), spread_by=[c for c, t in stream.dtypes if not t.startswith("map")])
    return stream
