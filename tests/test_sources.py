"""Reading, loading, writing and configuration."""

import gzip
import json
from datetime import date

import pytest
from helpers import rows
from pyspark.sql import functions as F

from cohortry import schemas
from cohortry.operators import merge_partitions, report
from cohortry.plans import Audience, audiences_from, validate_audiences
from cohortry.sources import (CSV, TSV, audience_config, list_files, load, load_audiences,
                              load_report, read_delimited, read_lines, read_parquet_by_name, read_tolerant,
                              row_counts, spread, write_csv, write_table)

SCHEMA = schemas.struct([("id", "string"), ("n", "int"), ("d", "date"), ("x", "double")])


def gz(path, text):
    with gzip.open(path, "wt") as f:
        f.write(text)


@pytest.fixture
def drop(tmp_path):
    gz(tmp_path / "a.tsv.gz", 'p1\t1\t2025-01-02\t1.5\n"tab\there"\t2\t\t\n')
    gz(tmp_path / "b.tsv.gz", "p3\tx\t2025-01-02\t1\np4\t4\n\np5\t5\t2025-13-02\t2\np6\t6\t2025-01-03\t3\n")
    (tmp_path / "notes.txt").write_text("not data")
    return tmp_path


def test_headerless_gzip_tsv(spark, drop):
    df = read_delimited(spark, str(drop), SCHEMA, **TSV, glob="a*.gz", partitions=3)
    assert rows(df) == [("p1", 1, date(2025, 1, 2), 1.5), ("tab\there", 2, None, None)]


def test_gzip_csv_with_header(spark, tmp_path):
    gz(tmp_path / "c.csv.gz", 'id,n,d,x\n"a,b",1,2025-01-02,2\n')
    assert rows(read_delimited(spark, str(tmp_path), SCHEMA, **CSV)) == [
        ("a,b", 1, date(2025, 1, 2), 2.0)]


def test_tolerant_load_keeps_rejects(spark, drop):
    good, bad = load(spark, str(drop), SCHEMA, glob="*.gz")
    assert {r["id"] for r in good.collect()} == {"p1", "tab\there", "p6"}
    assert good.columns[-1] == "load_timestamp" and good.where("load_timestamp is null").count() == 0
    assert good.select("id").count() == 3               # judged alike whatever is selected
    assert {r["record"].split("\t")[0] for r in bad.collect()} == {"p3", "p4", "p5"}
    assert {r["_file"].split("/")[-1] for r in bad.collect()} == {"b.tsv.gz"}
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|parsing"):
        load(spark, str(drop), SCHEMA, glob="*.gz", on_error="abort")[0].collect()


@pytest.mark.parametrize("header", [False, True])
def test_line_of_the_first_error_over_many_splits(spark, tmp_path, header):
    files = {"late": [3100], "none": [], "two": [8, 2999], "head": [0]}
    for name, bad in files.items():
        lines = [f"p{i}\t{'x' if i in bad else i}\t2025-01-02\t1.5" + ("\n" if i % 500 == 7 else "") for i in range(4000)]
        (tmp_path / f"{name}.tsv").write_text("\n".join((["id\tn\td\tx"] if header else []) + lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        read = read_lines(spark, str(tmp_path), "*.tsv")
        assert read.select("_file", "_block").distinct().count() > 40
        report_ = load_report(read_tolerant(spark, str(tmp_path), SCHEMA, header=header), lines=read)
        got = {r["file"].split("/")[-1][:-4]: (r["error_count"], r["first_error_line"]) for r in report_.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, bad in files.items():
        text = (tmp_path / f"{name}.tsv").read_text().split("\n")
        want = next((i for i, line in enumerate(text, 1) if "\tx\t2025" in line), None)
        assert got[name] == (len(bad), want)


def test_exported_quotes_come_back(spark, tmp_path):
    df = spark.createDataFrame([('a "b", c', 1), ('"', 2), ("back\\slash", 3)], "id string, n int")
    write_csv(df, str(tmp_path / "o"))
    schema = schemas.struct([("id", "string"), ("n", "int")])
    assert rows(read_delimited(spark, str(tmp_path / "o"), schema, **CSV)) == rows(df)


def test_rules_are_counted_while_writing(spark, tmp_path):
    from cohortry.plans import failing, write_checked
    df = spark.range(1000).select(F.when(F.col("id") % 100 != 0, F.col("id") % 990).alias("k"), (F.col("id") - 3).alias("x"))
    rules = [("unique", "k"), ("not_null", "k"), ("expr", "x >= 0"), ("unique_combo", ("k", "x")), ("unique_combo", ("k",))]
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("checked", "rules")
    # range clustering reads its input twice; rows are counted once all the same
    found = write_checked(df, str(tmp_path / "t"), "any", rules, cluster_by=["x"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000
    got = {(r["rule"], r["target"]): (r["failures"], r["nulls"]) for r in found.collect()}
    keys = [i % 990 if i % 100 else None for i in range(1000)]
    twice = len({k for k in keys if k is not None and keys.count(k) > 1})
    assert got == {("unique", "k"): (twice, 0), ("not_null", "k"): (10, 10), ("expr", "x >= 0"): (3, 0),
                   ("unique_combo", "k,x"): (0, 0), ("unique_combo", "k"): (twice + 1, 0)}
    assert len(failing(found).collect()) == 4 and jobs.getJobIdsForGroup("checked")
    spark.sparkContext.setJobGroup("", "")
    same = {(r[0], r[1]): (r[2], r[3]) for r in report(df, rules).collect()}
    assert same == got


def test_counts_and_extremes_come_from_footers(spark, tmp_path):
    from cohortry.sources import footer_counts, footer_extremes
    df = spark.range(1000).select("id", F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("d"),
                                  F.lit("text").alias("t"))
    df.repartition(5).write.parquet(str(tmp_path / "t"))
    got = footer_extremes(spark, str(tmp_path / "t"), ["id", "d"])
    assert tuple(got.first()) == (1000, 0, 999, date(2025, 1, 1), date(2025, 2, 19))
    counts = footer_counts(spark, {"T": str(tmp_path / "t")})
    assert rows(counts) == [("T", 1000)]
    for df in (got, counts):
        said = plan(df)
        assert "PushedAggregation: [COUNT(*)" in said and "PushedAggregation: []" not in said
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_overlap_of_cohorts_by_hand(spark):
    from cohortry.operators import cohort_overlap
    sets = {"a": range(0, 5000, 2), "b": range(0, 5000, 3), "c": [7], "d": [8], "e": range(4990, 5010)}
    members = [(c, f"p{i}") for c, ids in sets.items() for i in ids]
    df = spark.createDataFrame([*members, *members[:50], ("a", None), (None, "p1")], "cohort string, individual_id string").repartition(7)
    got = {(r["cohort"], r["other"]): (r["ids"], r["other_ids"], r["both"]) for r in cohort_overlap(df).collect()}
    assert got == {(a, b): (len(set(sets[a])), len(set(sets[b])), len(set(sets[a]) & set(sets[b])))
                   for a in sets for b in sets if a < b}


def test_rules_over_no_rows(spark, tmp_path):
    from cohortry.plans import write_checked
    rules = [("unique", "id"), ("not_null", "id"), ("expr", "id >= 0")]
    for i, df in enumerate([spark.range(10).limit(0), spark.range(10).where("id > 100"), spark.createDataFrame([], "id long")]):
        found = write_checked(df, str(tmp_path / str(i)), "any", rules, cluster_by=["id"])
        assert [(r["failures"], r["nulls"]) for r in found.collect()] == [(0, 0)] * 3
        assert [(r["failures"], r["nulls"]) for r in report(df, rules).collect()] == [(0, 0)] * 3


def test_comments_are_stored_with_products(spark, tmp_path):
    df = schemas.with_comments(spark.createDataFrame([("p", 1.0)], "individual_id string, tot_spend_3mo double"))
    write_table(df, str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t")).schema
    assert stored["individual_id"].metadata["comment"] == "Person"
    assert "3 months" in stored["tot_spend_3mo"].metadata["comment"]
    assert all(f.metadata["comment"] for f in schemas.spine_schema().fields)


def test_load_report(spark, drop):
    (drop / "c.tsv.gz").write_bytes(__import__("gzip").compress(b""))
    got = {r["file"].split("/")[-1]: r for r in load_report(
        read_tolerant(spark, str(drop), SCHEMA, glob="*.gz"), list_files(spark, str(drop), "*.gz")).collect()}
    assert (got["c.tsv.gz"]["row_parsed"], got["c.tsv.gz"]["status"]) == (0, "LOADED")
    assert (got["a.tsv.gz"]["row_count"], got["a.tsv.gz"]["status"]) == (2, "LOADED")
    b = got["b.tsv.gz"]
    assert (b["row_parsed"], b["row_count"], b["error_count"], b["status"]) == (
        4, 1, 3, "PARTIALLY_LOADED")
    assert b["first_error"].startswith("p3")


def test_load_report_tells_equal_names_apart(spark, tmp_path):
    for name, text in (("d1", "a\t1\t2025-01-01\t1\n"), ("d2", "z\tbad\t2025-01-01\t1\na\tbad\tx\t1\n")):
        (tmp_path / name).mkdir()
        gz(tmp_path / name / "part-0.gz", text)
    got = {r["file"].split("/")[-2]: r for r in load_report(
        read_tolerant(spark, f"{tmp_path}/*", SCHEMA)).collect()}
    assert got["d1"]["status"] == "LOADED" and got["d2"]["status"] == "LOAD_FAILED"
    assert got["d2"]["first_error"].startswith("z")  # the first in the file, not in the alphabet


def test_parquet_files_of_unlike_columns(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").write.parquet(str(tmp_path / "t" / "d1"))
    spark.createDataFrame([(2, "x")], "A int, b string").write.parquet(str(tmp_path / "t" / "d2"))
    wanted = schemas.struct([("a", "int"), ("B", "string")])
    assert rows(read_parquet_by_name(spark, str(tmp_path / "t" / "*"), wanted)) == [(1, None), (2, "x")]


def test_files_and_patterns(spark, drop):
    assert list_files(spark, str(drop)).count() == 3
    assert list_files(spark, str(drop), glob="*.gz").count() == 2
    got = list_files(spark, str(drop), pattern=r"/a.*\.gz$").collect()
    assert [r["path"].split("/")[-1] for r in got] == ["a.tsv.gz"] and got[0]["length"] > 0


def test_parquet_by_name(spark, tmp_path):
    spark.createDataFrame([("1", 5)], "B string, extra int").write.parquet(str(tmp_path / "p"))
    df = read_parquet_by_name(spark, str(tmp_path / "p"), schemas.struct([("a", "date"), ("b", "int")]))
    assert rows(df) == [(None, 1)] and df.columns == ["a", "b"]


def test_catalog_comments(spark, tmp_path):
    schema = schemas.TABLES["transaction"]
    assert schemas.load_columns("transaction")[0] == "txid"
    assert all(f.metadata.get("comment") for t in schemas.TABLES.values() for f in t.fields)
    assert len(schemas.spine_schema().fields) == 155
    df = schemas.with_comments(spark.createDataFrame([], schema), {"txid": "Key"})
    df.write.parquet(str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).schema["txid"].metadata["comment"] == "Key"


def test_write_table_and_csv(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    write_table(df, str(tmp_path / "t"), cluster_by=["k"], partitions=4)
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 1000 and len(list((tmp_path / "t").glob("*.parquet"))) == 4
    write_csv(df, str(tmp_path / "c"), single_file=True)
    assert len(list((tmp_path / "c").glob("*.csv"))) == 1
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 1000


def test_files_are_sorted_within_partitions(spark, tmp_path):
    import pyarrow.parquet as pq
    df = spark.range(5000).select((F.col("id") * 7919 % 4999).alias("id"), (F.col("id") % 3).cast("string").alias("m"),
                                  (F.col("id") * 31 % 97).alias("day"))
    write_table(df, str(tmp_path / "t"), cluster_by=["day", "id"], partition_by=["m"], partitions=3)
    files = list((tmp_path / "t").glob("m=*/*.parquet"))
    assert files
    for f in files:
        got = pq.ParquetFile(f).read(columns=["day", "id"]).to_pylist()
        assert got == sorted(got, key=lambda r: (r["day"], r["id"]))


def test_row_counts_and_spread(spark):
    df = spark.range(10)
    assert rows(row_counts({"A": df, "B": df.limit(0)})) == [("A", 10), ("B", 0)]
    assert spread(df.coalesce(1), "id").rdd.getNumPartitions() == 8
    assert spread(df.repartition(20), "id").rdd.getNumPartitions() == 20


# --- configuration and validation --------------------------------------------------------------
CONFIG = {"defaults": {"date_start": "2025-09-01", "date_end": "2025-10-01"},
          "audiences": [{"audience_id": "a1", "name": "One", "brand_keywords": ["QUILLMART"]},
                        {"audience_id": "a2", "name": "Two", "brand_keywords": ["x", "y"],
                         "date_start": "2025-08-01"}]}


def test_config_files(spark, tmp_path):
    yaml = pytest.importorskip("yaml")
    (tmp_path / "c.json").write_text(json.dumps(CONFIG))
    (tmp_path / "c.yml").write_text(yaml.safe_dump(CONFIG))
    (tmp_path / "empty.json").write_text('{"audiences": []}')
    for name in ("c.json", "c.yml"):
        one, two = audiences_from(load_audiences(spark, str(tmp_path / name)))
        assert one == Audience("a1", "One", ("QUILLMART",), date(2025, 9, 1), date(2025, 10, 1))
        assert two.date_start == date(2025, 8, 1)
    with pytest.raises(ValueError, match="no audiences"):
        load_audiences(spark, str(tmp_path / "empty.json"))
    with pytest.raises(FileNotFoundError):
        load_audiences(spark, str(tmp_path / "nowhere.yml"))
    with pytest.raises(ValueError, match="brand_keywords"):
        audience_config(spark, CONFIG["defaults"], [{"audience_id": "a", "name": "n"}])


def test_validation_with_repeated_ids(spark):
    fact = spark.createDataFrame(
        [("p1", "t1", date(2025, 9, 2), 10.0, "QUILLMART", None, None),
         ("p1", "t2", date(2025, 9, 3), 20.0, "X", None, None),
         ("p2", "t3", date(2025, 8, 3), 5.0, "X", None, None),
         (None, "t4", date(2025, 9, 3), 7.0, "QUILLMART", None, None)],
        "individual_id string, txid string, trans_date date, trans_amount double, "
        "brand_name string, store_name string, merchant_description string")
    lookup = spark.createDataFrame([("p1", "a1", 2), ("p1", "a1", 2), ("p9", "a1", 2),
                                    ("p2", "a1", 1), ("p2", "a2", 1)],
                                   "individual_id string, audience_id string, ver int")
    meta = spark.createDataFrame([("a1", 1), ("a1", 2), ("a2", 1)], "audience_id string, ver int")
    audiences = audiences_from(audience_config(spark, CONFIG["defaults"], CONFIG["audiences"]))
    audiences.append(Audience("a3", "Nobody", ("QUILLMART",), date(2025, 9, 1), date(2025, 10, 1)))
    whole = rows(validate_audiences(spark, audiences, lookup, meta, fact))
    bad = [Audience("b1", "No date", ("QUILLMART",), None, date(2025, 10, 1)),
           Audience("b2", "No words", (), date(2025, 9, 1), date(2025, 10, 1))]
    mixed = validate_audiences(spark, [bad[0], *audiences, bad[1]], lookup, meta, fact)
    assert rows(mixed.where("error is null")) == whole
    assert {(r["audience_id"], r["error"], r["shop_rate"]) for r in mixed.where("error is not null").collect()} == {
        ("b1", "a date is missing", None), ("b2", "there are no keywords", None)}
    assert validate_audiences(spark, bad, lookup, meta, fact).count() == 2
    one = next(r for r in validate_audiences(spark, audiences, lookup, meta, fact).collect()
               if r["audience_id"] == "a1")
    # repeated member ids do not count twice; the unknown person's spend is in the baseline only
    assert (one["total_lal_ids"], one["active_matched_ids"], one["brand_spend"]) == (2, 1, 10.0)
    assert (one["baseline_active_ids"], one["baseline_spend_rate"]) == (1, 17.0)
    nobody = next(r for r in whole if r[1] == "a3")
    assert nobody[2] == 0 and nobody[-2] is None
    with pytest.raises(ValueError):
        validate_audiences(spark, [], lookup, meta, fact)


def test_names_are_matched_like_text_by_text(spark):
    from cohortry.plans.validation import name_hits
    names = ["QUILLMART 12", "THE QUILL", "Q", "", "ABABAB", "X%Y_Z", "\u00c9T\u00c9 \U0001f600", "BABA", "12"]
    sets = [(0, ["QUILL"]), (1, ["Q"]), (2, ["AB", "BA"]), (3, ["%", "ZZZ"]), (4, ["\u00c9T\u00c9 \U0001f600"]), (5, [""]), (6, ["BABABA", "1"]),
            (7, ["NOTHING HERE", "LL 12"])]
    got = rows(name_hits(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame(
        [(i, k) for i, ks in sets for k in ks], "set_no int, keyword string")))
    assert got == sorted(((n, i) for n in names for i, ks in sets if any(k in n for k in ks)), key=repr)


def test_many_audiences_in_one_plan(spark):
    """A thousand audiences of five keywords: the plan does not grow with them."""
    fact = spark.range(2000).select(
        (F.col("id") % 50).cast("string").alias("individual_id"), F.col("id").cast("string").alias("txid"),
        F.date_add(F.lit("2025-09-01").cast("date"), (F.col("id") % 60).cast("int")).alias("trans_date"),
        (F.col("id") % 9).cast("double").alias("trans_amount"), F.concat(F.lit("brand "), F.col("id") % 300).alias("brand_name"),
        F.lit(None).cast("string").alias("store_name"), F.lit("shop").alias("merchant_description"))
    lookup = spark.range(50).select(F.col("id").cast("string").alias("individual_id"), F.concat(F.lit("a"), "id").alias("audience_id"),
                                    F.lit(1).alias("ver"))
    meta = lookup.select("audience_id", "ver").distinct()
    many = [Audience(f"a{i}", f"n{i}", (f"Brand {i}", f"BRAND 1{i}", "nowhere", "none", "brandx"), date(2025, 9, 1 + i % 20), date(2025, 10, 1))
            for i in range(1000)]
    got = {r["audience_id"]: r for r in validate_audiences(spark, many, lookup, meta, fact).collect()}
    assert len(got) == 1000
    facts = fact.collect()
    for i in (0, 3, 29, 200, 999):
        inside = [f for f in facts if many[i].date_start <= f.trans_date < many[i].date_end]
        hits = [f for f in inside if f"brand {i}" in f.brand_name or f"brand 1{i}" in f.brand_name]
        assert got[f"a{i}"]["baseline_active_ids"] == len({f.individual_id for f in inside})
        assert got[f"a{i}"]["baseline_brand_shoppers"] == len({f.individual_id for f in hits})
        mine = [f for f in hits if f.individual_id == str(i)]
        assert got[f"a{i}"]["brand_transactions"] == len(mine) and got[f"a{i}"]["total_lal_ids"] == (i < 50)
        assert got[f"a{i}"]["brand_spend"] == sum(f.trans_amount for f in mine)


def test_quality_report_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", -1), (None, None), (None, 5)], "k string, x int")
    got = {(r[0], r[1]): (r[2], r[3]) for r in report(df, [
        ("unique", "k"), ("not_null", "k"), ("expr", "x >= 0"), ("unique_combo", ("k", "x"))]).collect()}
    assert got == {("unique", "k"): (1, 0), ("not_null", "k"): (2, 2), ("expr", "x >= 0"): (1, 1),
                   ("unique_combo", "k,x"): (0, 0)}


# --- partitioned upsert ------------------------------------------------------------------------
def test_merge_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "id string, day string, v int"

    def merge(data):
        merge_partitions(spark, path, spark.createDataFrame(data, schema), ["id"], "day")

    def table():
        return rows(spark.read.schema(schema).parquet(path).select("id", "day", "v"))
    merge([("a", "d1", 1), ("b", "d1", 2), ("c", "d2", 3)])
    merge([("b", "d1", 20), ("d", "d3", 4)])
    assert table() == [("a", "d1", 1), ("b", "d1", 20), ("c", "d2", 3), ("d", "d3", 4)]
    merge([("c", "d3", 30)])                    # the only row of d2 moves away
    assert table() == [("a", "d1", 1), ("b", "d1", 20), ("c", "d3", 30), ("d", "d3", 4)]
    merge([("c", "d3", 30)])                    # repeating a batch changes nothing
    assert len(table()) == 4


# --- layout ------------------------------------------------------------------------------------
def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_without_a_shuffle(spark):
    from cohortry.sources import save_bucketed, save_table
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for name in ("bucketed_a", "bucketed_b"):
            save_bucketed(spark.range(100).withColumnRenamed("id", "person"), name, "person", 4)
        joined = spark.table("bucketed_a").join(spark.table("bucketed_b"), "person", "left")
        assert joined.count() == 100 and "Exchange" not in plan(joined)
        save_table(joined, "clustered", cluster_by=["person"])
        assert spark.table("clustered").count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in ("bucketed_a", "bucketed_b", "clustered"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_month_folders_are_pruned(spark, tmp_path):
    from cohortry.operators import month_text, with_month
    from cohortry.plans import rfm_features, seed_ids
    from cohortry.plans.validation import person_measures
    assert [month_text(date(2025, 3, 31), n) for n in (0, 3, 12)] == ["2025-03", "2024-12", "2024-03"]
    fact = spark.createDataFrame(
        [("p", f"t{y}{m}", date(y, m, 15), 1.0, "QUILLMART", None, None, "ONLINE")
         for y in (2023, 2024, 2025) for m in range(1, 13)],
        "individual_id string, txid string, trans_date date, trans_amount double, brand_name string,"
        " store_name string, merchant_description string, transaction_channel string")
    with_month(fact, "trans_date").write.partitionBy("trans_month").parquet(str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    ref = date(2025, 3, 31)
    for make in (lambda f: rfm_features(f, ref), lambda f: seed_ids(f, ["quillmart"], ref, 6, 2),
                 lambda f: person_measures(f, [(date(2025, 2, 1), date(2025, 3, 1), ("QUILLMART",))])[0]):
        assert rows(make(stored)) == rows(make(fact))
        assert "trans_month" in plan(make(stored)).split("PartitionFilters: [")[1].split("]")[0]
