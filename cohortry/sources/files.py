"""Reading delivered files, keeping rejected rows, and reporting what was loaded."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

REJECT = "_corrupt_record"
#: format presets: separator and header
TSV = {"sep": "\t", "header": False}
CSV = {"sep": ",", "header": True}


def read_parquet_by_name(spark: SparkSession, path: str, schema: T.StructType,
                         glob: str | None = None) -> DataFrame:
    """Parquet matched to ``schema`` by name in any case; absent columns are NULL, others unread.

    Files of one drop may have different columns: the names of all footers count.  Two names in a file
    that differ in case alone are an error.
    """
    reader = spark.read.option("mergeSchema", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.parquet(path)
    by_name = {c.lower(): c for c in df.columns}
    out = []
    for f in schema.fields:
        found = by_name.get(f.name.lower())
        value = F.lit(None) if found is None else F.col(f"`{found}`")
        out.append(value.cast(f.dataType).alias(f.name, metadata=f.metadata))
    return df.select(*out)


def spread(df: DataFrame, *keys: str, task_rows: int | None = None) -> DataFrame:
    """Deals the rows of a source with fewer splits than cores out to all cores, by key hash.

    For unsplittable input (a gzip file, a Parquet file of one row group).  A source with enough
    splits, as any large one has, comes back unchanged.  ``task_rows`` asks for as many parts as keep each
    at about that many rows, for narrow sources whose rows become wide: the rows are counted first, which
    Parquet answers from its footers.
    """
    parts = df.sparkSession.sparkContext.defaultParallelism
    if task_rows:
        parts = max(parts, -(-df.count() // task_rows))
    return df.repartition(parts, *keys) if df.rdd.getNumPartitions() < parts else df


def _reader(spark, schema, sep, header, glob, **options):
    reader = spark.read.schema(schema).options(sep=sep, header=header, quote='"', escape='"',
                                               dateFormat="yyyy-MM-dd", **options)
    return reader.option("pathGlobFilter", glob) if glob else reader


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = "\t",
                   header: bool = False, glob: str | None = None,
                   partitions: int | None = None) -> DataFrame:
    """Delimited text, columns by position (gzip recognised by its suffix); a bad row is an error.

    A gzip file cannot be split, so it is one task; ``partitions`` spreads the rows after reading.
    """
    df = _reader(spark, schema, sep, header, glob, mode="FAILFAST").csv(path)
    return df.repartition(partitions) if partitions else df


def load(spark: SparkSession, path: str, schema: T.StructType, sep: str = "\t",
         header: bool = False, glob: str | None = None,
         on_error: str = "continue") -> tuple[DataFrame, DataFrame | None]:
    """(good rows with ``load_timestamp``, rejected rows with their file and text).

    ``on_error="continue"`` skips rows that do not fit the schema and keeps them for inspection;
    ``"abort"`` fails the load on the first one.
    """
    if on_error == "abort":
        return with_load_ts(read_delimited(spark, path, schema, sep, header, glob)), None
    rows = read_tolerant(spark, path, schema, sep, header, glob)
    good = rows.where(F.col(REJECT).isNull()).select(*schema.fieldNames())
    bad = rows.where(F.col(REJECT).isNotNull()).select("_file", F.col(REJECT).alias("record"))
    return with_load_ts(good), bad


def read_tolerant(spark: SparkSession, path: str, schema: T.StructType, sep: str = "\t",
                  header: bool = False, glob: str | None = None) -> DataFrame:
    """Every row, good or bad: schema columns, the raw text of a bad row, the file's path, and a place
    that rises through a file."""
    wide = T.StructType(schema.fields + [T.StructField(REJECT, T.StringType())])
    rows = _reader(spark, wide, sep, header, glob, mode="PERMISSIVE",
                   columnNameOfCorruptRecord=REJECT).csv(path)
    # The reader converts only the columns a plan uses, and so judges rows by those alone.  Tying the
    # reject text to an always-true test over all columns makes every plan judge whole rows.
    whole_row = F.hash(*schema.fieldNames()) >= F.lit(-2**31)
    return rows.select(*schema.fieldNames(), F.when(whole_row, F.col(REJECT)).alias(REJECT),
                       F.col("_metadata.file_path").alias("_file"),
                       F.struct(F.col("_metadata.file_block_start").alias("block"),
                                F.monotonically_increasing_id().alias("row")).alias("_place"))


def with_load_ts(df: DataFrame) -> DataFrame:
    return df.withColumn("load_timestamp", F.current_timestamp())


def read_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Every line of text files: the file's path, the line and its place (first byte of the split, place in it)."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("value").alias("line"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"))


def line_numbers(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """``file, line, number``: the first line, from 1, of each ``file, line`` in ``wanted`` that is in the file.

    A split is read from its start to its end by one task, so a line's place in its split follows from the row
    ids; lines of the splits before it are added as prefix sums over one row per split.  Files are not sorted.
    """
    files = wanted.select(F.col("file").alias("_file")).distinct()
    inside = lines.join(files, "_file", "left_semi")
    splits = inside.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("_file", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    found = inside.join(wanted.select(F.col("file").alias("_file"), "line").distinct(), ["_file", "line"])
    return found.join(splits, ["_file", "_block"]).groupBy(F.col("_file").alias("file"), "line").agg(
        F.min(F.col("_before") + F.col("_row") - F.col("_first") + 1).alias("number"))


def load_report(rows: DataFrame, files: DataFrame | None = None, lines: DataFrame | None = None) -> DataFrame:
    """Per file of :func:`read_tolerant`, by its path: rows parsed, loaded, rejected, the first rejected
    row in file order and a status.  With ``files`` (from :func:`list_files`) files without rows are
    listed too; with ``lines`` (from :func:`read_lines`) ``first_error_line`` has the number of that row's line
    in its file, header and empty lines counted.  Lines are only read of files with rejected rows."""
    bad = F.col(REJECT).isNotNull()
    report = rows.groupBy(F.col("_file").alias("file")).agg(
        F.count(F.lit(1)).alias("row_parsed"),
        F.count_if(~bad).alias("row_count"),
        F.count_if(bad).alias("error_count"),
        F.min_by(REJECT, F.when(bad, F.col("_place"))).alias("first_error"))
    if lines is not None:
        bad_rows = report.where(F.col("first_error").isNotNull()).select("file", F.col("first_error").alias("line"))
        numbers = line_numbers(lines, bad_rows).select("file", F.col("number").alias("first_error_line"))
        report = report.join(numbers, "file", "left")
    if files is not None:
        counts = ["row_parsed", "row_count", "error_count"]
        report = files.select(F.col("path").alias("file")).join(report, "file", "left").fillna(0, subset=counts)
    return report.withColumn("status", F.when(F.col("error_count") == 0, "LOADED")
                             .when(F.col("row_count") == 0, "LOAD_FAILED").otherwise("PARTIALLY_LOADED"))


def list_files(spark: SparkSession, path: str, glob: str | None = None,
               pattern: str | None = None) -> DataFrame:
    """Path, size and modification time of files, by glob or by regular expression on the name."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).select("path", "length", "modificationTime")
    return files.where(F.col("path").rlike(pattern)) if pattern else files


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application in which counts and extremes of Parquet files come from their footers:
    no column is read."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def footer_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """:func:`row_counts` of stored Parquet tables, from the files' footers alone."""
    own = footer_session(spark)
    return row_counts({name: own.read.parquet(path) for name, path in paths.items()})


def footer_extremes(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row: ``row_count`` and for each column ``<column>_min`` and ``<column>_max``, from the footers alone.

    For numbers and dates of an unpartitioned table; text, whose extremes footers may shorten, and partition
    columns are read by Spark in the usual way.
    """
    stored = footer_session(spark).read.parquet(path)
    return stored.agg(F.count(F.lit(1)).alias("row_count"), *[
        f(c).alias(f"{c}_{name}") for c in columns for name, f in (("min", F.min), ("max", F.max))])


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows."""
    return reduce(DataFrame.unionAll, [
        df.agg(F.count(F.lit(1)).alias("row_count"))
          .select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()])
