"""Data products on hand-made frames, one case per documented decision."""

from datetime import date

import pytest
from helpers import rows
from pyspark.sql import functions as F

from cohortry import schemas
from cohortry.functions import codes
from cohortry.operators import DuplicateKeys, since_high_water, upsert
from cohortry.plans import (add_rates, daily_summary, enrich_transactions, gaussian_weights,
                            household_rollup, lookalike_scores, media_rollup, person_attributes,
                            person_rollup, rfm_features, seed_grid, seed_ids, tune_seed)
from cohortry.plans.attributes import source_columns

D = date


def frame(spark, table, data):
    return spark.createDataFrame(data, schemas.TABLES[table])


def sources(spark):
    tx = frame(spark, "transaction", [
        ("t1", "m1", "c1", D(2025, 9, 1), "10:00:00", "EST", 10.0, D(2025, 9, 3)),
        ("t2", "m2", "c1", D(2025, 9, 1), "11:00:00", "PST", 20.0, D(2025, 9, 4)),
        ("t3", "m3", "c2", D(2025, 8, 1), "11:00:00", "EST", 30.0, D(2025, 8, 4)),
        ("t4", "m1", "c9", D(2025, 8, 2), "11:00:00", None, 40.0, D(2025, 8, 4)),
        ("t5", None, None, D(2025, 8, 3), "11:00:00", None, 50.0, D(2025, 8, 4)),
        ("t6", "m1", "c1", None, "11:00:00", None, 60.0, D(2025, 8, 4))])
    card = frame(spark, "card", [("c1", "10001", "CR", "A1", "p1", None),
                                 ("c2", "10002", "DB", "A1", "p2", None),
                                 ("c3", "10003", "DB", "A1", None, None)])
    merchant = frame(spark, "merchant", [
        ("m1", "QUILLMART 12", "5651", "NYC", "NY", "10001", "US", None),
        ("m2", "TARGET 9", "5311", "NYC", "NY", "10002", "US", None)])
    tagging = frame(spark, "brand_tagging", [
        ("m1", 1, 1, "B&M", "l1"), ("m1", 2, 2, "ONLINE", None), ("m3", 3, 3, "ONLINE", "l9")])
    taxonomy = frame(spark, "brand_taxonomy", [(1, 1, "Quillmart", "QUILLMART", "D", "D", 1),
                                               (2, 2, "dd's", "DDS", "D", "P", 0)])
    location = frame(spark, "brand_location",
                     [("l1", "1 Main", "NYC", "NY", "10001", "US", "2001", None)])
    ids = lambda *x: frame(spark, "experiment_ids", [(i,) for i in x])
    return tx, card, merchant, tagging, taxonomy, location, ids("p1", "p1"), ids("p1", "p2", "p2")


def test_enrich_matches_plain_left_joins(spark):
    tx, card, merchant, tagging, taxonomy, location, control, exposed = sources(spark)
    fact = enrich_transactions(*sources(spark))
    plain = (tx.where("trans_date is not null").alias("t")
             .join(card.alias("c"), F.expr("t.membccid = c.membccid"), "left")
             .join(merchant.alias("m"), F.expr("t.mtid = m.mtid"), "left")
             .join(tagging.alias("b"), F.expr("t.mtid = b.mtid"), "left")
             .join(taxonomy.alias("x"),
                   F.expr("b.store_id = x.store_id and b.brand_id = x.brand_id"), "left")
             .join(location.alias("l"), F.expr("b.locationid = l.locationid"), "left")
             .selectExpr("txid", "c.individual_id", "m.mtid", "merch_desc", "b.store_id",
                         "channel", "brand_name", "l.city"))
    cols = ["txid", "individual_id", "mtid", "merchant_description", "store_id",
            "transaction_channel", "brand_name", "store_city"]
    assert rows(fact.select(*cols)) == rows(plain)
    assert len(fact.columns) == 35
    # one terminal with two tags gives two rows; both experiment lists hold p1, control wins
    assert fact.where("txid = 't1'").count() == 2
    groups = {r["txid"]: r["experiment_group"] for r in fact.collect()}
    assert groups == {"t1": "CONTROL", "t2": "CONTROL", "t3": "EXPOSED", "t4": None, "t5": None}


@pytest.mark.parametrize("kw", [{"salt_from": 2}, {"dedupe_tags": False}])
def test_enrich_join_strategies_agree(spark, kw):
    assert rows(enrich_transactions(*sources(spark), **kw)) == \
        rows(enrich_transactions(*sources(spark)))


def test_enrich_modes(spark):
    s = sources(spark)
    assert {r[0] for r in enrich_transactions(*s, start="2025-08-01", end="2025-08-02")
            .select("txid").collect()} == {"t3", "t4"}
    assert {r[0] for r in enrich_transactions(*s, since="2025-08-03").select("txid").collect()} \
        == {"t1", "t2"}
    one = enrich_transactions(*s, dedupe_tags=True).where("txid = 't1'").collect()
    assert [r["store_id"] for r in one] == [1]


def test_summary_lists_need_two_values(spark):
    got = {(r["trans_date"], r["individual_id"]): r
           for r in daily_summary(enrich_transactions(*sources(spark))).collect()}
    p1, p2 = got[D(2025, 9, 1), "p1"], got[D(2025, 8, 1), "p2"]
    assert len(p1.asDict()) == 35 and set(k[1] for k in got) == {"p1", "p2"}
    assert p1["transaction_count"] == 3 and p1["total_transaction_amount"] == 40.0
    assert p1["brand_name_str_list"] == "DDS,QUILLMART"          # two values
    assert p1["merchant_state_str_list"] is None            # one value
    assert p2["brand_name_str_list"] is None                # none
    assert (p1["unique_brand_count"], p2["unique_brand_count"]) == (2, 1)
    assert p2["unique_merchant_count"] == 0
    assert p1["brand_tagging_classification_str_list"] == "0,1"
    assert p1["trans_time_zone"] == "EST"                   # two of three


def spine(spark, *people):
    cols = source_columns("individual_id")
    schema = schemas.spine_schema()
    return spark.createDataFrame([tuple(p.get(c) for c in cols) for p in people], schema)


def test_attributes_edges(spark):
    p = {"individual_id": "p1", "lu_a_adat": "20250131", "combined_age_1": "E18",
         "rec_adultcnt": "", "rec_childcnt": None, "pocv4_0_3_code": "1Y",
         "pocv4_16_18_code": "5Y", "ocup_model_v2_1": "K3", "combined_homeowner": "8"}
    ids = frame(spark, "experiment_ids", [("p1",), ("p1",)])
    df = person_attributes(spine(spark, p, p, {"individual_id": "p2"}), ids, ids,
                           as_of=D(2025, 11, 13))
    got = {r["individual_id"]: r for r in df.collect()}
    assert len(df.columns) == 156 and df.count() == 2       # whole-row duplicate removed
    assert got["p1"]["experiment_group"] == "CONTROL"
    assert got["p1"]["child_age_group"] == "0-3, 16-18"
    assert got["p2"]["child_age_group"] is None
    assert got["p1"]["occupation_model"] == "PROFESSIONAL_KNOWN"
    assert got["p2"]["occupation_model"] == "UNKNOWN"
    assert got["p1"]["homeowner_status"] == "HOMEOWNER"
    assert got["p2"]["homeowner_status"] == "UNKNOWN"
    assert (got["p1"]["adults_in_hh"], got["p1"]["number_of_children"]) == (0, 0)
    assert got["p2"]["partition_date"] == D(2025, 11, 13)
    assert got["p2"]["business_owner"] == "NO" and got["p2"]["experiment_group"] is None


def test_attributes_latest_only(spark):
    old = {"individual_id": "p1", "lu_a_adat": "20240131", "gndr_gndr_1": "M"}
    new = {"individual_id": "p1", "lu_a_adat": "20250131", "gndr_gndr_1": "F"}
    got = person_attributes(spine(spark, old, new), as_of="2025-11-13", latest_only=True).collect()
    assert [r["gender"] for r in got] == ["FEMALE"] and len(got[0]) == 156


def test_rollup_strictness(spark):
    people = spine(spark, {"individual_id": "a", "combined_age_1": "E20", "lu_inc_model_v6": "D",
                           "lu_inc_model_v6_amt": "040"},
                   {"individual_id": "b", "combined_age_1": "I75", "lu_inc_model_v6": "F",
                    "lu_inc_model_v6_amt": "080"})
    attrs = person_attributes(people, as_of="2025-01-01")
    def codes_of(strict):
        p = {r["individual_id"]: (r["age_bucket"], r["age_bucket_detailed"])
             for r in person_rollup(attrs, strict_reference=strict).collect()}
        h = {r["household_id"]: r["income_bucket"]
             for r in household_rollup(attrs, strict_reference=strict).collect()}
        return p, h
    assert codes_of(False) == ({"a": (1, 1), "b": (7, 12)}, {"a": 2, "b": 5})
    assert codes_of(True) == ({"a": (0, 0), "b": (7, 12)}, {"a": 3, "b": 6})


def test_media_counts_and_absent_types(spark):
    people = spine(spark, {"individual_id": "a", "tv_mov_drama_fan": "10",
                           "tv_mov_drama_movies": "90"}, {"individual_id": "b"},
                   {"individual_id": "c", "rs_video_brand_hulu": "Y", "tv_mov_horror": ""})
    attrs = person_attributes(people, as_of="2025-01-01")
    for unique in (False, True):
        got = {r["individual_id"]: r for r in media_rollup(attrs, unique_keys=unique).collect()}
        assert set(got) == {"a", "c"}                       # no tag, no row
        assert got["a"]["genres_watched"] == {"film/drama": 2}
        assert got["a"]["titles_watched"] == {"drama": 1}
        assert got["a"]["networks_watched"] == {}           # absent type is an empty map
        assert got["c"]["app_services_used"] == {"hulu": 1}
    likely_only = {r["individual_id"]: r for r in media_rollup(attrs, threshold=50).collect()}
    assert likely_only["a"]["genres_watched"] == {"film/drama": 1}


def small_fact(spark, data):
    schema = "individual_id string, trans_date date, trans_amount double, " \
             "transaction_channel string, brand_name string, store_name string, " \
             "merchant_description string, txid string"
    return spark.createDataFrame([(*r, None, None, str(i)) for i, r in enumerate(data)], schema)


def test_rfm_window_edges(spark):
    ref = D(2025, 3, 31)
    fact = small_fact(spark, [
        ("a", D(2024, 3, 31), 1.0, "ONLINE", "X"),          # exactly 12 months back: in
        ("a", D(2024, 3, 30), 1.0, "ONLINE", "Y"),          # a day earlier: out
        ("a", D(2025, 2, 28), 2.0, "B&M", "X"),             # month end clamps: in the month window
        ("a", D(2025, 3, 31), 4.0, "B&M", None),            # the reference date itself: in
        ("a", D(2025, 4, 1), 8.0, "B&M", "Z"),              # after it: out
        ("b", D(2024, 12, 31), 3.0, None, "X"), (None, D(2025, 1, 1), 9.0, "ONLINE", "X")])
    got = {r["individual_id"]: r for r in rfm_features(fact, ref).collect()}
    a, b = got["a"], got["b"]
    assert set(got) == {"a", "b"} and len(a) == 35
    assert (a["tot_trans_12mo"], a["tot_trans_3mo"], a["tot_trans_1mo"]) == (3, 2, 2)
    assert (a["tot_spend_12mo"], a["tot_online_spend_12mo"], a["tot_online_spend_1mo"]) == (7., 1., 0.)
    assert (a["brand_diversity_12mo"], a["brand_diversity_1mo"]) == (1, 1)
    assert a["avg_days_btwn_trans_1mo"] == 31.0 and a["avg_days_btwn_trans_12mo"] == 182.5
    assert (a["days_since_last_txn"], a["online_ratio_12mo"]) == (0, pytest.approx(1 / 3))
    assert b["avg_days_btwn_trans_12mo"] is None and b["tot_spend_1mo"] == 0
    assert b["tot_online_trans_12mo"] == 0 and b["rfm_ref_date"] == ref
    assert rfm_features(fact.limit(0)).count() == 0


def test_seed_grid_and_tuning(spark):
    ref = D(2025, 3, 31)
    data = [(f"p{i}", D(2025, 3, 1), 1.0, "B&M", "QUILLMART") for i in range(6) for _ in range(i + 1)]
    data += [("p9", D(2024, 4, 30), 1.0, "B&M", "QUILLMART")] * 9
    fact = small_fact(spark, data)
    rfm = rfm_features(fact, ref)
    grid = seed_grid(fact, rfm, ["quillmart"], ref)
    size = {(r[0], r[1], r[2]): r[3] for r in grid.collect()}
    assert size[12, 3, None] == 5 and size[12, 3, 180] == 4 and size[6, 5, None] == 2
    for (months, k, recency), n in size.items():
        ids = seed_ids(fact, ["quillmart"], ref, months, k, rfm=rfm, max_recency=recency)
        assert ids.count() == n
    assert tune_seed(grid, (3, 3)).min_transactions == 5
    assert tune_seed(grid, (100, 200)).seed_size == 5       # all below: the loosest


def population(spark, data):
    return spark.createDataFrame(data, "individual_id string, is_seed int, x double, g string")


@pytest.mark.parametrize("data,scores", [
    # one seed: its deviation is NULL, the bandwidth falls back to half the population's
    ([("a", 1, 1.0, "m"), ("b", 0, 2.0, "m"), ("c", 0, 3.0, "f")], 3),
    # identical values: no deviation at all, the numeric term is 0 for everybody
    ([("a", 1, 1.0, "m"), ("b", 0, 1.0, "m")], 2),
    # a feature nobody has
    ([("a", 1, None, "m"), ("b", 0, None, None)], 2),
    # empty seed: no audience
    ([("a", 0, 1.0, "m"), ("b", 0, 2.0, "f")], 0), ([], 0)])
def test_lookalike_degenerate_inputs(spark, data, scores):
    out = lookalike_scores(population(spark, data), numeric=["x"], categorical=["g"]).collect()
    assert len(out) == scores
    assert all(r["similarity_score"] is not None for r in out)


def test_lookalike_values_and_missing_features(spark):
    data = [("a", 1, 1.0, "m"), ("b", 0, 2.0, "f"), ("c", 0, 6.0, "m"), ("d", 0, None, None)]
    out = {r["individual_id"]: r for r in lookalike_scores(
        population(spark, data), numeric=["x"], categorical=["g"]).collect()}
    mean, std = 3.0, 7.0 ** 0.5
    weight, width = 2.0 / std, 0.5 * std
    assert out["a"]["numeric_similarity_score"] == pytest.approx(weight)
    assert out["b"]["numeric_similarity_score"] == pytest.approx(
        weight * 2.718281828459045 ** (-0.5 * (1 / width) ** 2))
    assert mean and out["d"]["similarity_score"] == 0
    assert out["c"]["categorical_similarity_score"] == pytest.approx(1.5)   # 1 * (1 / (2/3))
    assert out["b"]["categorical_similarity_score"] == 0


def test_lookalike_fields_by_join(spark):
    data = [(f"p{i}", int(i % 3 == 0), float(i), f"v{i % 7}") for i in range(60)]
    pop = population(spark, data)
    literal = rows(lookalike_scores(pop, numeric=["x"], categorical=["g"]))
    assert rows(lookalike_scores(pop, numeric=["x"], categorical=["g"], joined=["g"])) == literal


def test_gaussian_weights_floor():
    w = gaussian_weights([{"feature": "f", "seed_mean": 5.0, "seed_std": 0.1, "pop_mean": 5.0,
                           "pop_std": 2.0}])
    assert w == {"f": (5.0, 1.0, 0.1)}


def test_field_classes():
    assert (len(codes.NUMERIC_FIELDS), len(codes.CATEGORICAL_FIELDS)) == (35, 12)


# published counts and the shop rate %, transactions per shopper and lift they give
GOLDEN = [
    (228581, 63771, 242142, 121775, 27.90, 3.80, 98.8),
    (1496058, 64656, 243027, 121775, 4.32, 3.76, 15.3),
    (497399, 6948, 22051, 121775, 1.40, 3.17, 4.9),
    (18969993, 68604, 219354, 121775, 0.36, 3.20, 1.3),
    (2919651, 1029549, 1716801, 2799977, 35.26, 1.67, 5.4),
    (4345506, 1050007, 1737259, 2799977, 24.16, 1.65, 3.7),
    (499144, 82862, 130840, 2799977, 16.60, 1.58, 2.6),
    (28666748, 2286553, 3529286, 2799977, 7.98, 1.54, 1.2),
    (79769, 25336, 371524, 57283, 31.76, 14.66, 239.1),
    (1115457, 25728, 371916, 57283, 2.31, 14.46, 17.4),
    (98628, 1485, 13275, 57283, 1.51, 8.94, 11.3),
    (18128656, 29400, 227954, 57283, 0.16, 7.75, 1.2),
    (6576908, 5343089, 28063998, 20446678, 81.24, 5.25, 1.7),
    (7512364, 5654378, 28859924, 20446678, 75.27, 5.10, 1.6),
]


def test_published_rates(spark):
    schema = "n int, active_matched_ids long, brand_shoppers long, brand_transactions long, " \
             "baseline_brand_shoppers long, baseline_active_ids long, brand_spend double, " \
             "baseline_brand_spend double"
    df = spark.createDataFrame([(i, *g[:4], 43114357, 1.0, 1.0) for i, g in enumerate(GOLDEN)],
                               schema)
    for r in add_rates(df).collect():
        shop, per_shopper, lift = GOLDEN[r["n"]][4:]
        assert round(r["shop_rate"] * 100, 2) == shop
        assert round(r["avg_transactions_per_shopper"], 2) == per_shopper
        assert round(r["shop_rate_lift"], 1) == lift


def test_rates_without_active_members(spark):
    df = spark.createDataFrame([(0, 0, 0, 5, 10, 0.0, 3.0)],
                               "active_matched_ids long, brand_shoppers long, "
                               "brand_transactions long, baseline_brand_shoppers long, "
                               "baseline_active_ids long, brand_spend double, "
                               "baseline_brand_spend double")
    r = add_rates(df).first()
    assert (r["shop_rate"], r["average_ticket"], r["shop_rate_lift"], r["spend_rate_lift"]) == (
        0.0, 0.0, None, None)


# --- incremental -------------------------------------------------------------------------------
def test_upsert_replaces_and_adds(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert rows(upsert(old, new, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]
    with pytest.raises(DuplicateKeys):
        upsert(old, new.union(new), ["k"])


def test_high_water_empty_target_and_late_rows(spark):
    df = spark.createDataFrame([(D(2025, 1, d),) for d in range(1, 11)], "d date")
    target = df.where("d <= date'2025-01-05'")
    assert since_high_water(df, target, "d").count() == 5
    assert since_high_water(df, target, "d", lookback_days=2).count() == 7
    assert since_high_water(df, target.limit(0), "d").count() == 10
    assert since_high_water(df, None, "d").count() == 10
