"""Registered queries against their SQL, over tables with odd rows."""

import duckdb
import pytest
from check import compare
from cohortry.llm.workload import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    assert compare(spark, con, sf_dir, name, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, sf_dir, name, tmp_path):
    import pyarrow.parquet as pq
    for t in ("documents", "benchmark", "conversations", "pages", "labels"):
        table = pq.read_table(f"{sf_dir}/{t}.parquet")
        pq.write_table(table.slice(0, 0), tmp_path / f"{t}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == (1 if name == "op6_chat" else 0)
