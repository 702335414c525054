"""One callable per operator or product, over the whole sample tables.

``present`` turns results into plain columns (text dates and maps, BIGINT, DOUBLE to 6 digits) so they
compare across engines; the library itself returns native types.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry import schemas
from cohortry.functions import (codes, in_range, keyword_match, likely, map_text, month_filter,
                                normalise, split_list, tag_array)
from cohortry.operators import (active_ids, category_importance, category_shares, cohort_except,
                                cohort_intersect, cohort_overlap, cohort_union, count_distinct_ids,
                                distinct_rows, expr_true,
                                label_membership, latest_version, materialise, not_null,
                                numeric_profile, ref_date, report, scratch_path, since_high_water,
                                summarise, top_n, unique, unique_combo, upsert, window_diversity, with_month)
from cohortry.plans import (audiences_from, build_fact, check_products, choose_seed, daily_summary, daily_summary_stream,
                            enrich_transactions, household_rollup,
                            lookalike_scores, media_long, media_rollup, person_attributes,
                            person_rollup, population_features, preset, reach_curve, rfm_features,
                            rfm_segments, run_delta, score_population, seed_grid, seed_ids,
                            validate_audiences, write_fact)
from cohortry.sources import (footer_counts, footer_extremes, list_files, load, load_report, merge_defaults, read_delimited, read_lines,
                              read_parquet_by_name, read_tolerant, row_counts, save_table, write_csv, write_table)
from cohortry.streaming import (daily_stream, enrich_stream, ingest_stream, load_history, load_stream, loaded_rows,
                                rejected_rows, upsert_stream, write_stream)

from . import adapters as A
from .adapters import Domain

HOLDOUT = tuple(date.fromisoformat(d) for d in A.HOLDOUT)
PINNED = date(2001, 6, 30)
MID = date(2001, 3, 31)
ID = "individual_id"


def present(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, T.MapType):
            c = map_text(c)
        elif isinstance(t, T.ArrayType):
            c = F.array_join(c, "|")
        elif isinstance(t, T.DateType):
            c = c.cast("string")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.DecimalType, T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6)
        out.append(c.alias(f.name))
    return df.select(*out)


def _fact(d: Domain, **kw) -> DataFrame:
    return enrich_transactions(d.tx, d.card, d.merchant, d.tagging, d.taxonomy, d.location,
                               d.control, d.exposed, **kw)


def _attrs(d: Domain) -> DataFrame:
    return person_attributes(d.spine, d.control, d.exposed, as_of=A.AS_OF)


def _core(attrs: DataFrame, *cols: str) -> DataFrame:
    return attrs.select(ID, *cols)


def _ref(d: Domain) -> date:
    if d.latest is None:
        d.latest = ref_date(d.tx, "trans_date")
    return d.latest


def _seed(d: Domain, fact=None, **kw) -> DataFrame:
    args = {"keywords": A.KEYWORDS, "ref": _ref(d), "lookback_months": 12, "min_transactions": 2}
    return seed_ids(_fact(d) if fact is None else fact, **{**args, **kw})


def _population(d: Domain, base: str = "attributes") -> DataFrame:
    fact = _fact(d)
    return population_features(_attrs(d), rfm_features(fact, _ref(d)), _seed(d, fact), base)


def _scores(d: Domain) -> DataFrame:
    """Scores at the precision that is compared, so that both engines rank alike."""
    s = score_population(_population(d))
    return s.withColumn("similarity_score", F.round("similarity_score", 6))


def _audiences(d: Domain):
    entries = d.sql(A.CONFIG_ENTRIES).withColumn("brand_keywords", F.split("keywords", ","))
    return merge_defaults(entries, A.CONFIG_DEFAULTS)


# --- sources -----------------------------------------------------------------------------------
def scan_parquet_by_name(d):
    wanted = schemas.struct([("C_CUSTKEY", "string"), ("C_NAME", "string"),
                             ("c_MktSegment", "string"), ("not_delivered", "string")])
    return read_parquet_by_name(d.spark, f"{d.dir}/customer.parquet", wanted)


DROP_SCHEMA = schemas.struct([("custkey", "int"), ("segment", "string"), ("opened", "date"),
                              ("balance", "double")])


def _dropped_files(d) -> DataFrame:
    """Customers written as headerless gzip TSV, some balances and dates unreadable, then read back."""
    path = scratch_path(d.spark, "drop")
    rows = d.sql(
        "SELECT CAST(c_custkey AS STRING) AS custkey, c_mktsegment AS segment, "
        "CASE WHEN c_custkey % 11 = 3 THEN 'soon' ELSE '2001-01-05' END AS opened, "
        "CASE WHEN c_custkey % 7 = 2 THEN 'n/a' ELSE CAST(c_acctbal AS STRING) END AS balance "
        "FROM customer")
    rows.write.option("sep", "\t").option("compression", "gzip").csv(path)
    return read_tolerant(d.spark, path, DROP_SCHEMA, glob="*.gz")


def load_rejects(d):
    rows = _dropped_files(d)
    return rows.where(F.col("_corrupt_record").isNotNull()).select(
        F.split("_corrupt_record", "\t")[0].alias("custkey"),
        F.split("_corrupt_record", "\t")[1].alias("segment"))


def load_good(d):
    rows = _dropped_files(d)
    return rows.where(F.col("_corrupt_record").isNull()).select(*DROP_SCHEMA.fieldNames())


def _segment_files(d) -> str:
    """Customers as CSV with a header, one file a segment in the order of their keys, some values unreadable."""
    path = scratch_path(d.spark, "segments")
    rows = d.sql(
        "SELECT c_custkey AS custkey, CASE WHEN c_custkey % 11 = 3 THEN 'soon' ELSE '2001-01-05' END AS opened, "
        "CASE WHEN c_custkey % 7 = 2 THEN 'n/a' ELSE CAST(c_acctbal AS STRING) END AS balance, "
        "c_mktsegment AS segment FROM customer")
    rows.repartition("segment").sortWithinPartitions("segment", "custkey").write.partitionBy("segment").option(
        "header", True).csv(path)
    return path


SEGMENT_SCHEMA = schemas.struct([("custkey", "int"), ("opened", "date"), ("balance", "double")])


def _segment(path_col: str):
    return F.regexp_extract(path_col, "segment=([^/]*)/", 1).alias("segment")


def load_report_files(d):
    """Per file: counts, status and the line of the first row that was rejected."""
    path = _segment_files(d)
    rows = read_tolerant(d.spark, path, SEGMENT_SCHEMA, sep=",", header=True)
    found = load_report(rows, list_files(d.spark, path, glob="*.csv"), read_lines(d.spark, path, glob="*.csv"))
    return found.select(_segment("file"), "row_parsed", "row_count", "error_count", "first_error_line", "status",
                        F.split("first_error", ",")[0].alias("first_custkey"))


def list_segments(d):
    """The files of a folder whose path fits a pattern."""
    files = list_files(d.spark, _segment_files(d), pattern=r"segment=[A-M][^/]*/part-[^/]*\.csv$")
    return files.select(_segment("path"), (F.col("length") > 0).alias("filled"))


def load_stamped(d):
    """Good rows with the time they were loaded."""
    begin = d.spark.sql("SELECT current_timestamp()").first()[0]
    good, _ = load(d.spark, _segment_files(d), SEGMENT_SCHEMA, sep=",", header=True)
    return good.select("custkey", "opened", "balance", (F.col("load_timestamp") >= F.lit(begin)).alias("stamped"))


def load_columns(d):
    """Delivered columns in another order, some of them not wanted: those of the typed catalog stay."""
    path = scratch_path(d.spark, "columns")
    d.tx.withColumn("surplus", F.lit(1)).select("surplus", *reversed(d.tx.columns)).write.parquet(path)
    return read_parquet_by_name(d.spark, path, schemas.TABLES["transaction"]).select(*schemas.load_columns("transaction"))


def csv_export(d):
    """The customers exported with a header and read back, commas, quotes and blanks included."""
    path = scratch_path(d.spark, "export")
    rows = d.sql("SELECT c_custkey AS custkey, c_name || ', \"' || c_mktsegment || '\"' AS label, "
                 "CAST(c_acctbal AS STRING) AS balance FROM customer")
    write_csv(rows, path)
    return read_delimited(d.spark, path, schemas.struct([("custkey", "int"), ("label", "string"), ("balance", "string")]),
                          sep=",", header=True)


def _table_name() -> str:
    return f"cohortry_{uuid.uuid4().hex}"


def saved_audience(d):
    """Scores stored as a catalog table, clustered by id, and read back."""
    name = _table_name()
    save_table(_scores(d).select(ID, "is_seed", "similarity_score"), name, cluster_by=[ID])
    return d.spark.table(name)


def documented_table(d):
    """The comments that the catalog keeps of the person dimension's columns."""
    name = _table_name()
    save_table(schemas.with_comments(_attrs(d)), name, comment="One row per person: 'decoded' demographics")
    return d.spark.sql(f"DESCRIBE TABLE {name}").select("col_name", "comment")


def clustered_fact(d):
    """The fact stored by month, sorted by date and person in each file, and read whole."""
    path = scratch_path(d.spark, "clustered")
    write_fact(_fact(d), path)
    return d.spark.read.parquet(path).drop("trans_month")


def interleaved_fact(d):
    """The fact stored so that a filter on dates or on persons skips files, and read whole."""
    path = scratch_path(d.spark, "interleaved")
    write_table(materialise(_fact(d)), path, interleave_by=["trans_date", ID], partitions=16)
    return d.spark.read.parquet(path)


def merged_drop(d):
    """A drop whose files have different columns in different spelling, matched by name."""
    path = scratch_path(d.spark, "unlike")
    d.sql("SELECT c_custkey AS C_CUSTKEY, c_name FROM customer WHERE c_custkey % 2 = 0").write.parquet(path)
    d.sql("SELECT c_custkey AS C_CUSTKEY, c_mktsegment, c_acctbal AS surplus FROM customer WHERE c_custkey % 2 = 1").write.mode(
        "append").parquet(path)
    return read_parquet_by_name(d.spark, path, schemas.struct([("c_custkey", "int"), ("C_Name", "string"),
                                                               ("c_mktsegment", "string")]))


def load_report_totals(d):
    per_file = load_report(_dropped_files(d))
    return per_file.agg(F.sum("row_parsed").alias("row_parsed"), F.sum("row_count").alias("row_count"),
                        F.sum("error_count").alias("error_count"),
                        F.max(F.col("first_error").isNotNull().cast("int")).alias("has_error"))


def q_row_counts(d):
    return row_counts({t.upper(): d.table(t) for t in [*A.TABLES, *A.TEXT_TABLES]})


def row_counts_footers(d):
    return footer_counts(d.spark, {t.upper(): f"{d.dir}/{t}.parquet" for t in [*A.TABLES, *A.TEXT_TABLES]})


def key_extremes(d):
    """First and last keys of the orders, from the footers."""
    return footer_extremes(d.spark, f"{d.dir}/orders.parquet", ["o_orderkey", "o_custkey"])


def audience_config(d):
    return _audiences(d)


# --- fact and summaries ------------------------------------------------------------------------
def enrich(d):
    return _fact(d)


def enrich_salted(d):
    """Cards and terminals with many rows are dealt out to many tasks."""
    return _fact(d, salt_from=45)


def enrich_batch(d):
    return _fact(d, start="2001-01-01", end="2001-01-31")


def experiment_group(d):
    return label_membership(d.spine.select(ID), ID,
                            [("CONTROL", d.control), ("EXPOSED", d.exposed)], "experiment_group")


def q_daily_summary(d):
    return daily_summary(materialise(_fact(d)))


def daily_summary_spread(d):
    """The largest groups are aggregated value by value, as groups too large for one task would be."""
    return daily_summary(materialise(_fact(d)), split_from=8)


def daily_mode(d):
    rows = _fact(d).where(F.col(ID).isNotNull())
    return summarise(rows, ["trans_date", ID], {"transaction_count": F.count(F.lit(1))},
                     mode_cols={"trans_time_zone": "trans_time_zone", "top_brand": "brand_name"})


def distinct_lists(d):
    rows = _fact(d).where(F.col(ID).isNotNull())
    return summarise(rows, ["trans_date", ID], {},
                     list_cols={"brand_name": "brand_list", "store_id": "store_list"},
                     distinct_cols={"mtid": "terminals"})


def q_distinct_rows(d):
    return distinct_rows(_fact(d), ["trans_date", "brand_name", "merchant_state",
                                    "transaction_channel"])


def incremental_slice(d):
    fact = _fact(d)
    return since_high_water(fact, fact.where(F.col("trans_date") <= F.lit(MID)), "trans_date",
                            lookback_days=3).select("txid", "trans_date", "trans_amount")


def _built(d, *runs) -> DataFrame:
    """The daily summary as several runs of the build leave it: (last date of the transactions known, mode)."""
    out = scratch_path(d.spark, "build")
    for last, kw in runs:
        tx = d.tx if last is None else d.tx.where(F.col("trans_date") <= F.lit(last))
        build_fact(d.spark, {"transaction": tx, "card": d.card, "merchant": d.merchant,
                             "brand_tagging": d.tagging, "brand_taxonomy": d.taxonomy,
                             "brand_location": d.location, "control": d.control, "exposed": d.exposed}, out, **kw)
    return d.spark.read.parquet(out + "/daily_summary").drop("trans_month")


def build_incremental(d):
    """A first run up to a date, then two that find later transactions."""
    return _built(d, (MID, {"mode": "incremental"}), (PINNED, {"mode": "incremental"}),
                  (None, {"mode": "incremental", "lookback_days": 3}))


def build_range(d):
    """A full run, then a back-fill over the turn of a month."""
    return _built(d, (None, {"mode": "full"}),
                  (None, {"mode": "range", "start": date(2001, 1, 20), "end": date(2001, 2, 10)}))


def merge_upsert(d):
    """Summary up to a date, upserted with a later run that overlaps it by a month."""
    fact = _fact(d)
    old = daily_summary(fact.where(F.col("trans_date") <= F.lit(MID)), split_from=None) \
        .withColumn("transaction_count", F.col("transaction_count") + 1000)
    new = daily_summary(fact, since=date(2001, 2, 28), split_from=None)
    cols = ["trans_date", ID, "transaction_count", "total_transaction_amount"]
    return upsert(old.select(*cols), new.select(*cols), ["trans_date", ID])


def holdout_filter(d):
    return _fact(d).where(in_range("trans_date", *HOLDOUT)) \
        .select("txid", ID, "trans_date", "trans_amount")


def brand_filter(d):
    names = ["brand_name", "store_name", "merchant_description"]
    return _fact(d).where(keyword_match(names, ["Ring", "brand#1", "GIZMO 4"])) \
        .select("txid", *names)


def q_ref_date(d):
    return d.tx.agg(F.max("trans_date").alias("ref_date"))


def normalise_values(d):
    f = _fact(d)
    return f.select(
        "txid", normalise("merchant_description", lower=True, hyphenate=True).alias("merchant"),
        normalise("store_state", upper=True).alias("state"),
        F.size(split_list(F.concat_ws(",", "store_name", "brand_name"))).alias("parts"))


# --- person dimension --------------------------------------------------------------------------
def attributes(d):
    return _attrs(d)


def decode_codes(d):
    return _core(_attrs(d), *[n for n, *_ in codes.DECODED_FIELDS], "occupation_model")


def parse_age_(d):
    return _core(_attrs(d), "age")


def age_bucket(d):
    return _core(_attrs(d), "age_bucket")


def income_amount_(d):
    return _core(_attrs(d), "household_income_k")


def hh_counts(d):
    return _core(_attrs(d), "adults_in_hh", "number_of_children", "num_people_in_household_group",
                 "median_home_value_by_state")


def partition_date(d):
    return _core(_attrs(d), "partition_date")


def child_age_group(d):
    return _core(_attrs(d), "child_age_group", "presence_of_children")


def q_person_rollup(d):
    return person_rollup(_attrs(d))


def person_rollup_strict(d):
    return person_rollup(_attrs(d), strict_reference=True)


def age_code_(d):
    return person_rollup(_attrs(d)).select(ID, "age_bucket", "age_bucket_detailed")


def interest_maps(d):
    return person_rollup(_attrs(d)).select(ID, "general_interests", "sports_interests",
                                           "reading_interests")


def flag_maps(d):
    return person_rollup(_attrs(d)).select(ID, "travel_interests", "credit_card_info")


def argmin_label_(d):
    return person_rollup(_attrs(d)).select(ID, "investment_type")


def propensity_flags(d):
    return _attrs(d).select(ID, *[likely(c, scale).cast("int").alias(t.lower())
                                  for c, _, t, scale in codes.CREDIT_CARDS])


def q_household_rollup(d):
    return household_rollup(_attrs(d))


def household_rollup_strict(d):
    return household_rollup(_attrs(d), strict_reference=True)


def income_code_(d):
    return household_rollup(_attrs(d)).select("household_id", "income", "income_bucket")


def hh_flags(d):
    return household_rollup(_attrs(d)).select("household_id", "homeowner", "presence_of_children")


def child_age_map(d):
    return household_rollup(_attrs(d)).select("household_id", "child_age_group")


def dynamic_maps(d):
    return household_rollup(_attrs(d)).select("household_id", "median_home_value_by_state")


def media_tags(d):
    return media_long(_attrs(d)).groupBy("attr_type", "attr_value") \
        .agg(F.count(F.lit(1)).alias("people"))


def q_media_long(d):
    return media_long(_attrs(d))


def tag_arrays(d):
    return _attrs(d).select(ID, tag_array(codes.MEDIA_TAGS["networks"]).alias("networks"),
                            tag_array(codes.MEDIA_TAGS["titles"]).alias("titles"))


def q_media_rollup(d):
    return media_rollup(_attrs(d))


def media_rollup_unique(d):
    return media_rollup(_attrs(d), unique_keys=True)


# --- features and seeds ------------------------------------------------------------------------
def q_rfm_features(d):
    """The reference date is that of the latest transaction, read from the transactions alone."""
    return rfm_features(_fact(d), _ref(d))


def rfm_pinned(d):
    return rfm_features(_fact(d), PINNED)


def brand_diversity(d):
    return window_diversity(_fact(d), ID, "trans_date", "brand_name", _ref(d), codes.RFM_WINDOWS)


def q_rfm_segments(d):
    return rfm_segments(rfm_features(_fact(d), _ref(d)))


def q_seed_ids(d):
    return _seed(d)


def seed_retail(d):
    return _seed(d, **preset("retail"))


def seed_cause(d):
    return _seed(d, **preset("cause"))


def seed_gaming(d):
    return _seed(d, **preset("gaming", lookback_months=6))


def seed_holiday(d):
    args = preset("holiday", keywords=["RING", "WIDGET"])
    return _seed(d, **args)


def month_filters(d):
    """Calendar filters alone: early and late holiday season, everywhere and by year."""
    keep = month_filter("trans_date", include=[11, 12], exclude_range=("11-23", "12-24"))
    rows = _fact(d).where(keep & F.col(ID).isNotNull())
    return rows.groupBy(F.year("trans_date").alias("year")).agg(
        F.count(F.lit(1)).alias("transactions"), F.count_distinct(ID).alias("people"))


def seed_recency(d):
    fact = _fact(d)
    return _seed(d, fact, rfm=rfm_features(fact, _ref(d)), max_recency=60)


def seed_online(d):
    return _seed(d, channel="ONLINE", min_transactions=1)


def q_seed_grid(d):
    fact, ref = _fact(d), _ref(d)
    return seed_grid(fact, rfm_features(fact, ref), A.KEYWORDS, ref, min_transactions=(1, 2, 3),
                     max_recency=60)


def tuned_seed(d):
    """The grid's setting for a range that some size meets, one all are above, and one all are below."""
    grid = materialise(q_seed_grid(d))
    targets = {"hit": (20, 60), "too_many": (0, 1), "too_few": (10**8, 10**9)}
    parts = [choose_seed(grid, t).select(F.lit(n).alias("target"), "*") for n, t in targets.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def pop_features(d):
    return _population(d)


def pop_features_rfm(d):
    return _population(d, base="rfm")


def q_numeric_profile(d):
    return numeric_profile(materialise(_population(d)), "is_seed", codes.NUMERIC_FIELDS)


def q_category_shares(d):
    return category_shares(_population(d), "is_seed", codes.CATEGORICAL_FIELDS)


def categorical_importance(d):
    return category_importance(category_shares(_population(d), "is_seed",
                                               codes.CATEGORICAL_FIELDS))


def q_lookalike_scores(d):
    return lookalike_scores(_population(d))


def top_n_audience(d):
    return top_n(_scores(d).select(ID, "is_seed", "similarity_score"), "similarity_score", ID, 500)


def top_n_ranges(d):
    """The same audience from many small ranges and rounds, as for tens of millions of members."""
    return top_n(_scores(d).select(ID, "is_seed", "similarity_score"), "similarity_score", ID, 500,
                 range_rows=64, buckets=8)


def lookalike_scores_n(d):
    return lookalike_scores(_population(d), n=500, digits=6)


def lookalike_scores_half(d):
    """The better half of the population with ranks."""
    pop = materialise(_population(d))
    return lookalike_scores(pop, n=pop.count() // 2, digits=6, store=False)


# --- audiences ---------------------------------------------------------------------------------
def q_latest_version(d):
    return latest_version(d.lookup, d.metadata)


def audience_validation(d):
    return validate_audiences(d.spark, audiences_from(_audiences(d)), d.lookup, d.metadata,
                              _fact(d))


def validation_many(d):
    """Some thousand audiences of five keywords, some of them without a window."""
    entries = d.sql(A.MANY_CONFIG).withColumn("brand_keywords", F.array(*[f"word{i}" for i in range(1, 6)]))
    lookup = d.sql(A.MANY_LOOKUP)
    return validate_audiences(d.spark, audiences_from(merge_defaults(entries, {})), lookup,
                              lookup.select("audience_id", "ver").distinct(), _fact(d))


def validation_by_seed(d):
    fact = _fact(d)
    return validate_audiences(d.spark, audiences_from(_audiences(d)), d.lookup, d.metadata, fact,
                              seed=_seed(d, fact, min_transactions=1))


def q_reach_curve(d):
    return reach_curve(_scores(d), _fact(d), [100, 400, 1000], A.KEYWORDS, *HOLDOUT)


def q_run_delta(d):
    """Validation with version 1 members against validation with the latest version."""
    audiences, fact = audiences_from(_audiences(d)), materialise(_fact(d))
    first = d.metadata.where("ver = 1")
    metrics = ["total_lal_ids", "active_matched_ids", "brand_shoppers", "brand_spend", "shop_rate"]
    runs = [validate_audiences(d.spark, audiences, d.lookup, m, fact) for m in (first, d.metadata)]
    return run_delta(*runs, "audience_id", metrics)


def semi_active(d):
    return active_ids(_fact(d), d.spine, ID, "trans_date", *HOLDOUT)


def count_ids(d):
    online = in_range("trans_date", *HOLDOUT) & (F.col("transaction_channel") == "ONLINE")
    return count_distinct_ids(_fact(d), ID, online, "online_people")


def _cohorts(d):
    fact = _fact(d)
    summer = seed_ids(fact, ["RING"], date(2001, 7, 31), 3)
    spring = seed_ids(fact, ["RING"], date(2001, 4, 30), 3)
    return summer, spring


def q_cohort_union(d):
    return cohort_union(*_cohorts(d))


def q_cohort_intersect(d):
    return cohort_intersect(*_cohorts(d))


def q_cohort_except(d):
    return cohort_except(*_cohorts(d))


def q_cohort_overlap(d):
    """Every two of the audiences of both versions and two seeds."""
    summer, spring = _cohorts(d)
    members = d.lookup.select(ID, F.concat_ws(" ", "audience_id", "ver").alias("cohort"))
    for name, ids in (("summer", summer), ("spring", spring)):
        members = members.unionByName(ids.select(ID, F.lit(name).alias("cohort")))
    return cohort_overlap(members)


# --- data quality ------------------------------------------------------------------------------
def dq_unique(d):
    return unique(_fact(d), "txid")


def dq_not_null(d):
    return not_null(_fact(d), ID).select("txid", "membccid")


def dq_unique_combo(d):
    return unique_combo(_fact(d), ["trans_date", "membccid"])


def dq_expression(d):
    return expr_true(_fact(d), "trans_amount >= 5000").select("txid", "trans_amount")


def dq_report(d):
    return report(_fact(d), [
        ("unique", "txid"), ("not_null", "txid"), ("not_null", "trans_date"),
        ("not_null", "trans_amount"), ("not_null", ID), ("not_null", "mtid"),
        ("expr", "trans_amount >= 0"), ("expr", "brand_id <= 20"), ("expr", "length(mtid) < 4"),
        ("unique_combo", ("trans_date", ID))])


def dq_products(d):
    """All products stored, and what their rules find."""
    fact = materialise(_fact(d))
    attrs = materialise(_attrs(d))
    return check_products(
        {"fact": fact, "daily_summary": daily_summary(fact), "rfm_features": rfm_features(fact, _ref(d)), "attributes": attrs,
         "person_rollup": person_rollup(attrs), "household_rollup": household_rollup(attrs), "media_rollup": media_rollup(attrs)},
        scratch_path(d.spark, "products"))


# --- streaming ---------------------------------------------------------------------------------
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def _run(query):
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def _events(d, **kw):
    return ingest_stream(d.spark, d.dir, EVENTS, "parquet", glob="events.parquet", **kw)


def stream_ingest(d):
    out = scratch_path(d.spark, "ingest")
    for _ in range(2):  # the second run finds nothing new
        _run(write_stream(_events(d), out + "/data", out + "/checkpoint"))
    return d.spark.read.schema(EVENTS).parquet(out + "/data").withColumn(
        "ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def stream_daily(d):
    """Daily totals per user of the event stream, every day emitted."""
    out = scratch_path(d.spark, "daily")
    daily = daily_stream(_events(d), "ts", "user_id", "value")
    daily = daily.withColumn("month", F.date_format("day", "yyyy-MM"))
    _run(upsert_stream(daily, out + "/data", ["day", "user_id"], "month", out + "/checkpoint", mode="update"))
    return d.spark.read.schema(daily.schema).parquet(out + "/data").drop("month")


def _load_stream(d) -> str:
    src, out = _segment_files(d), scratch_path(d.spark, "loaded")
    for _ in range(2):  # the second run finds nothing new
        _run(load_stream(d.spark, src + "/*", SEGMENT_SCHEMA, out, out + "-checkpoint", sep=",", header=True, max_files=2))
    return out


def stream_load_good(d):
    return loaded_rows(d.spark, _load_stream(d), SEGMENT_SCHEMA)


def stream_load_rejects(d):
    bad = rejected_rows(d.spark, _load_stream(d))
    return bad.select(_segment("_file"), F.split("record", ",")[0].alias("custkey"))


def stream_load_history(d):
    found = load_history(d.spark, _load_stream(d))
    return found.select(_segment("file"), "row_parsed", "row_count", "error_count", "status",
                        F.split("first_error", ",")[0].alias("first_custkey"))


def stream_daily_summary(d):
    """The daily summary kept by a stream over three deliveries, some rows up to two days late."""
    src, out = scratch_path(d.spark, "fact-drops"), scratch_path(d.spark, "summary-stream")
    fact = materialise(_fact(d))
    delivered = F.date_add("trans_date", F.pmod(F.xxhash64("txid", "trans_time"), F.lit(3)).cast("int"))
    for inside in (delivered <= F.lit(MID), (delivered > F.lit(MID)) & (delivered <= F.lit(PINNED)),
                   delivered > F.lit(PINNED)):
        fact.where(inside).write.mode("append").parquet(src)
        days = daily_summary_stream(ingest_stream(d.spark, src, fact.schema, "parquet"), "3 days")
        days = with_month(days, "trans_date")
        _run(upsert_stream(days, out, ["trans_date", ID], "trans_month", out + "-checkpoint", mode="update"))
    return d.spark.read.schema(days.schema).parquet(out).drop("trans_month")


def stream_upsert_late(d):
    """Latest event per user from two deliveries, the later events first."""
    src, out = scratch_path(d.spark, "event-drops"), scratch_path(d.spark, "upsert-late")
    events = d.spark.read.schema(EVENTS).parquet(f"{d.dir}/events.parquet")
    for late in (False, True):
        part = F.pmod(F.dayofmonth("ts"), F.lit(2)) == int(late)  # days by turns
        events.where(part).write.mode("append").parquet(src)
        stream = ingest_stream(d.spark, src, EVENTS, "parquet").select(
            "user_id", "ts", "event_id", "event_type", (F.col("user_id") % 4).cast("int").alias("shard"))
        _run(upsert_stream(stream, out, ["user_id"], "shard", out + "-checkpoint", order_by="ts"))
    return d.spark.read.schema(stream.schema).parquet(out).select("user_id", "event_id", "event_type", "shard")


def stream_upsert(d):
    """Latest event per user, kept by upserting the stream into a table."""
    out = scratch_path(d.spark, "upsert")
    events = _events(d).select("user_id", "ts", "event_id", "event_type",
                               (F.col("user_id") % 4).cast("int").alias("shard"))
    _run(upsert_stream(events, out + "/data", ["user_id"], "shard", out + "/checkpoint",
                       order_by="ts"))
    return d.spark.read.schema(events.schema).parquet(out + "/data").select(
        "user_id", "event_id", "event_type", "shard")


def stream_enrich(d):
    out = scratch_path(d.spark, "enrich")
    cards = d.card.select(F.col("membccid").cast("bigint").alias("user_id"), "card_type", ID)
    rich = enrich_stream(_events(d).select("event_id", "user_id", "value"), [(cards, ["user_id"])])
    _run(write_stream(rich, out + "/data", out + "/checkpoint"))
    return d.spark.read.schema(rich.schema).parquet(out + "/data")


QUERIES: dict[str, Callable[[Domain], DataFrame]] = {
    "scan_parquet_by_name": scan_parquet_by_name, "load_rejects": load_rejects,
    "load_good": load_good, "load_report": load_report_totals, "row_counts": q_row_counts,
    "audience_config": audience_config,
    "enrich": enrich, "enrich_salted": enrich_salted, "enrich_batch": enrich_batch,
    "experiment_group": experiment_group, "daily_summary": q_daily_summary,
    "daily_summary_spread": daily_summary_spread, "daily_mode": daily_mode,
    "distinct_lists": distinct_lists, "distinct_rows": q_distinct_rows,
    "incremental_slice": incremental_slice, "merge_upsert": merge_upsert,
    "build_incremental": build_incremental, "build_range": build_range,
    "holdout_filter": holdout_filter, "brand_filter": brand_filter, "ref_date": q_ref_date,
    "normalise_values": normalise_values,
    "attributes": attributes, "decode_codes": decode_codes, "parse_age": parse_age_,
    "age_bucket": age_bucket, "income_amount": income_amount_, "hh_counts": hh_counts,
    "partition_date": partition_date, "child_age_group": child_age_group,
    "person_rollup": q_person_rollup, "person_rollup_strict": person_rollup_strict,
    "age_code": age_code_, "interest_map": interest_maps, "flag_map": flag_maps,
    "argmin_label": argmin_label_, "propensity_flags": propensity_flags,
    "household_rollup": q_household_rollup, "household_rollup_strict": household_rollup_strict,
    "income_code": income_code_, "hh_flags": hh_flags, "child_age_map": child_age_map,
    "dynamic_map": dynamic_maps, "media_tags": media_tags, "media_long": q_media_long,
    "tag_array": tag_arrays, "media_rollup": q_media_rollup,
    "media_rollup_unique": media_rollup_unique,
    "rfm_features": q_rfm_features, "rfm_pinned": rfm_pinned, "brand_diversity": brand_diversity,
    "rfm_segments": q_rfm_segments, "seed_ids": q_seed_ids, "seed_retail": seed_retail,
    "seed_holiday": seed_holiday, "month_filters": month_filters, "seed_recency": seed_recency,
    "seed_online": seed_online, "seed_grid": q_seed_grid, "pop_features": pop_features,
    "pop_features_rfm": pop_features_rfm, "numeric_profile": q_numeric_profile,
    "category_shares": q_category_shares, "categorical_importance": categorical_importance,
    "lookalike_scores": q_lookalike_scores, "top_n_audience": top_n_audience,
    "top_n_ranges": top_n_ranges, "lookalike_scores_n": lookalike_scores_n,
    "lookalike_scores_half": lookalike_scores_half,
    "latest_version": q_latest_version, "audience_validation": audience_validation,
    "validation_many": validation_many, "validation_by_seed": validation_by_seed, "reach_curve": q_reach_curve,
    "run_delta": q_run_delta, "semi_active": semi_active, "count_ids": count_ids, "cohort_union": q_cohort_union,
    "cohort_intersect": q_cohort_intersect, "cohort_except": q_cohort_except,
    "dq_unique": dq_unique, "dq_not_null": dq_not_null, "dq_unique_combo": dq_unique_combo,
    "dq_expression": dq_expression, "dq_report": dq_report,
    "stream_ingest": stream_ingest, "stream_daily": stream_daily, "stream_upsert": stream_upsert,
    "stream_enrich": stream_enrich,
    "row_counts_footers": row_counts_footers, "key_extremes": key_extremes, "tuned_seed": tuned_seed,
    "cohort_overlap": q_cohort_overlap,
    "load_report_files": load_report_files, "list_segments": list_segments, "load_stamped": load_stamped,
    "load_columns": load_columns, "csv_export": csv_export, "saved_audience": saved_audience,
    "documented_table": documented_table, "clustered_fact": clustered_fact, "interleaved_fact": interleaved_fact, "merged_drop": merged_drop,
    "seed_cause": seed_cause, "seed_gaming": seed_gaming, "dq_products": dq_products,
    "stream_load_good": stream_load_good, "stream_load_rejects": stream_load_rejects,
    "stream_load_history": stream_load_history, "stream_daily_summary": stream_daily_summary,
    "stream_upsert_late": stream_upsert_late,
}


def runner(fn: Callable[[Domain], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(fn(Domain(spark, sf_dir)))
    run.__name__ = fn.__name__
    return run
