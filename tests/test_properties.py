"""Properties that hold on the sample tables, and the whole build."""

from datetime import date, timedelta

import pytest
from helpers import rows
from pyspark.sql import functions as F

from cohortry.functions import codes
from cohortry.operators import category_shares, newer_than, upsert
from cohortry.plans import build_all, daily_summary, lookalike_scores, rfm_features
from cohortry.workload import adapters as A
from cohortry.workload.queries import _attrs, _fact, _population

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def domain(spark):
    return A.Domain(spark, SF)


@pytest.fixture(scope="module")
def fact(spark, domain, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fact"))
    _fact(domain).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_incremental_runs_equal_a_rebuild(fact):
    cuts = [date(1996, 6, 1), date(1999, 1, 1), date(2100, 1, 1)]
    built, mark = None, None
    for cut in cuts:
        step = daily_summary(fact.where(F.col("trans_date") < F.lit(cut)), since=mark)
        built = step if built is None else upsert(built, step, ["trans_date", "individual_id"])
        mark = cut - timedelta(days=1)
    assert rows(built) == rows(daily_summary(fact))
    assert newer_than(fact, "trans_date", date(2100, 1, 1)).count() == 0


def test_windows_are_nested(fact):
    rfm = rfm_features(fact)
    for metric in ("tot_trans", "tot_spend", "tot_online_trans", "tot_online_spend",
                   "brand_diversity"):
        names = [f"{metric}_{m}mo" for m in sorted(codes.RFM_WINDOWS)]
        assert rfm.where(" or ".join(f"{a} > {b}" for a, b in zip(names, names[1:]))).count() == 0


def test_shares_sum_to_one(domain):
    shares = category_shares(_population(domain), "is_seed", codes.CATEGORICAL_FIELDS)
    for r in shares.groupBy("field").agg(F.sum("seed_share").alias("s"), F.sum("pop_share").alias("p")) \
            .collect():
        assert r["s"] == pytest.approx(1) and r["p"] == pytest.approx(1)


def test_scores_do_not_depend_on_row_order(domain):
    pop = _population(domain)

    def scored(df):
        s = lookalike_scores(df).select("individual_id", F.round("similarity_score", 9))
        return rows(s)
    assert scored(pop) == scored(pop.repartition(5).sortWithinPartitions(F.desc("individual_id")))


def test_build_all(spark, domain, tmp_path):
    sources = {"transaction": domain.tx, "card": domain.card, "merchant": domain.merchant,
               "brand_tagging": domain.tagging, "brand_taxonomy": domain.taxonomy,
               "brand_location": domain.location, "spine": domain.spine,
               "control": domain.control, "exposed": domain.exposed}
    built = build_all(spark, sources, str(tmp_path), as_of=date(2001, 8, 1),
                      rfm_ref_date=date(2001, 6, 30))
    assert built["fact"].count() == 6000
    assert rows(built["rfm_features"]) == rows(rfm_features(_fact(domain), date(2001, 6, 30)))
    found = {(r["product"], r["rule"], r["target"]): r["failures"] for r in built["quality"].collect()}
    assert len(found) == 25 and found["fact", "not_null", "txid"] == 0
    assert built["rfm_features"].schema["last_txn_date"].metadata["comment"]
    assert built["attributes"].count() == built["person_rollup"].count() == _attrs(domain).count()
    assert len(list((tmp_path / "fact").glob("trans_month=*"))) > 12


@pytest.mark.parametrize("mode", [{"mode": "incremental"}, {"mode": "range", "start": date(2001, 1, 20), "end": date(2001, 2, 10)}])
@pytest.mark.parametrize("left", ["_temporary/0/x", "trans_month=2001-01/part-0.parquet"])
def test_a_first_run_that_died_while_writing_is_made_good(spark, domain, tmp_path, left, mode):
    """The folder of the fact is there, the mark of a finished write is not."""
    from cohortry.plans import build_fact
    sources = {"transaction": domain.tx, "card": domain.card, "merchant": domain.merchant, "brand_tagging": domain.tagging,
               "brand_taxonomy": domain.taxonomy, "brand_location": domain.location, "control": domain.control,
               "exposed": domain.exposed}
    (tmp_path / "fact" / left).parent.mkdir(parents=True)
    (tmp_path / "fact" / left).write_bytes(b"half")
    spark.createDataFrame([(True, None, None)], "every boolean, first date, last date").write.parquet(str(tmp_path / "_summary_due"))
    found = build_fact(spark, sources, str(tmp_path), **mode)
    stored = spark.read.parquet(str(tmp_path / "fact"))
    assert stored.count() == 6000 and not (tmp_path / "_summary_due").exists()
    assert spark.read.parquet(str(tmp_path / "daily_summary")).count() == daily_summary(stored).count()
    assert {r["product"] for r in found.collect()} == {"fact", "daily_summary"}


@pytest.mark.parametrize("failed", [None, {"mode": "incremental"}, {"mode": "incremental", "lookback_days": 40},
                                    {"mode": "range", "start": date(2001, 1, 20), "end": date(2001, 2, 10)}])
def test_a_run_that_fails_before_the_summary_is_made_good(spark, domain, tmp_path, monkeypatch, failed):
    import cohortry.plans.build as module
    dates = sorted(r[0] for r in domain.tx.select("trans_date").distinct().collect())
    middle, late = dates[len(dates) // 3], dates[2 * len(dates) // 3]

    def run(tx, **kw):
        module.build_fact(spark, {"transaction": tx, "card": domain.card, "merchant": domain.merchant,
                                  "brand_tagging": domain.tagging, "brand_taxonomy": domain.taxonomy,
                                  "brand_location": domain.location, "control": domain.control,
                                  "exposed": domain.exposed}, str(tmp_path), **kw)

    def crash(*args, **kw):
        raise RuntimeError("lost")
    upto = domain.tx.where(F.col("trans_date") <= F.lit(late))
    if failed is not None:
        run(upto.where((F.col("trans_date") <= F.lit(middle)) & (F.hash("txid") % 2 == 0)), mode="full")
    with monkeypatch.context() as m:
        m.setattr(module, "daily_summary", crash)
        with pytest.raises(RuntimeError):
            run(upto, **(failed or {"mode": "full"}))
    run(domain.tx, mode="incremental")
    stored = spark.read.parquet(str(tmp_path / "fact"))
    got = spark.read.parquet(str(tmp_path / "daily_summary"))
    assert rows(got.select("trans_date", "individual_id", "transaction_count")) == rows(
        daily_summary(stored).select("trans_date", "individual_id", "transaction_count"))
