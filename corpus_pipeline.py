"""The corpus pipeline: documents in, a cleaned, mixed and sharded corpus out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; between stages the rows are written as
Parquet and read again.  All but the last return the columns of ``documents``.

1. quality_rules: documents the rules reject go.
2. near_duplicates: one document of each group of near copies (similarity 0.8 or more on shingles of five words)
   stays, that of the least id.
3. decontamination: documents with a passage of the benchmark go.
4. mixing: documents repeat as often as the mix takes them, none to three times.
5. sharding: every row gets its ``shard``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortry.llm import decontamination, mixing, neardup, quality, sharding
from cohortry.llm.common import read
from cohortry.operators import materialise

SHARDS = 24
SHINGLE_WORDS = 5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.stage(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.stage(docs, SHINGLE_WORDS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.stage(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.stage(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.stage(docs, SHARDS)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
          ("decontamination", decontaminate), ("mixing", mix_sources), ("sharding", shard)]

#: MinHash candidates and the tree have no SQL form; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
