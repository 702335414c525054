"""Cutting lineage on shared storage, so that reuse survives the loss of executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a temp folder in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="cohortry-")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there, and later uses read only their
    columns.  Stays valid when executors are lost."""
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def stored_once(df: DataFrame) -> Iterator[DataFrame]:
    """Same for the length of a block; the files go with it, so that work that is repeated leaves none behind."""
    path = scratch_path(df.sparkSession, "batch")
    df.write.parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
