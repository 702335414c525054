"""Runs registered queries against their SQL twins: ``python tests/check.py SF_DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else repr(v + 0.0)
        return repr(v)
    return [columns[i] for i in order], sorted(tuple(value(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, query, sql):
    """None when equal, else a description of the difference."""
    df = query(spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = canonical([c[0] for c in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {set(got[0]) ^ set(want[0])}"
    if got[1] != want[1]:
        only_got = sorted(set(got[1]) - set(want[1]))[:2]
        only_want = sorted(set(want[1]) - set(got[1]))[:2]
        return f"{len(got[1])} rows, expected {len(want[1])}\n  got  {only_got}\n  want {only_want}"
    return None


def main(argv):
    from pyspark.sql import SparkSession
    import __spark_entry__ as E
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, names = argv[0], argv[1:]
    con, queries, oracles = connect(sf_dir), E.queries(), E.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name, queries[name], oracles[name]) \
                if name in oracles else f"no oracle, {queries[name](spark, sf_dir).count()} rows"
        except Exception as exc:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s "
              f"{problem or ''}", flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
