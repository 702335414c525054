"""Column expressions on hand-made edge values."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from cohortry.functions import (argmin_label, codes, decode, dynamic_map, flag, greatest_or_null,
                                income_amount, int_or_zero, interest_map, keyword_match, likely,
                                list_membership_map, map_text, month_filter, normalise, parse_age,
                                parse_yyyymmdd, ratio, split_list, tag_array)
from cohortry.functions.scalars import bucket


def values(spark, schema, data, *exprs):
    df = spark.createDataFrame(data, schema)
    return [tuple(r) if len(exprs) > 1 else r[0] for r in df.select(*exprs).collect()]


def test_decode_unknown_and_null_take_the_default(spark):
    got = values(spark, "c string", [("M",), ("x",), (None,)],
                 decode("c", codes.GENDER, "UNDETERMINED"))
    assert got == ["MALE", "UNDETERMINED", "UNDETERMINED"]


@pytest.mark.parametrize("text,age,label", [
    ("E18", 18, "18-24"), ("I75", 75, "60+"), ("", None, None), ("E", None, None),
    (None, None, None), ("E17", 17, None), ("Exx", None, None), ("I60", 60, "60+")])
def test_age(spark, text, age, label):
    a = parse_age("c")
    assert values(spark, "c string", [(text,)], a, bucket(a, codes.AGE_BOUNDS)) == [(age, label)]


def test_income_amount(spark):
    assert values(spark, "c string", [("042",), ("000",), (" ",), (None,), ("250",)],
                  income_amount("c")) == [42000, None, None, None, 250000]


def test_counts_accept_blank_null_and_text(spark):
    assert values(spark, "c string", [("",), (None,), ("3",), ("x",)],
                  int_or_zero("c")) == [0, 0, 3, 0]


def test_partition_date_from_text_and_date(spark):
    data = [("20250131",), ("2025",), (None,), ("2025-01-31",), ("20251399",)]
    as_of = date(2025, 11, 13)
    assert values(spark, "c string", data, parse_yyyymmdd("c", as_of)) == [
        date(2025, 1, 31), as_of, as_of, date(2025, 1, 31), as_of]
    assert values(spark, "c date", [(date(2025, 1, 31),)], parse_yyyymmdd("c", as_of)) == [
        date(2025, 1, 31)]


def test_likely_scales_and_null(spark):
    data = [("49",), ("50",), ("5",), ("6",), ("",), (None,), ("07",)]
    assert values(spark, "c string", data, likely("c"), likely("c", 10)) == [
        (True, False), (False, False), (True, True), (True, False), (False, False),
        (False, False), (True, False)]


def test_argmin_ties_go_to_the_first(spark):
    e = argmin_label([("a", "I"), ("b", "S"), ("c", "S"), ("d", "T")])
    data = [("10", "10", "9", "30"), ("10", "10", "20", "30"), ("", None, "x", "49"),
            ("50", "50", "60", "70"), (None, None, None, None)]
    assert values(spark, "a string, b string, c string, d string", data, e) == [
        "S", "I", "T", "Unknown", "Unknown"]


def test_greatest_or_null(spark):
    assert values(spark, "a double, b double", [(1.0, 2.0), (None, 2.0)],
                  greatest_or_null(F.col("a"), F.col("b"))) == [2.0, None]


def test_ratio_guards_zero(spark):
    assert values(spark, "a int, b int", [(1, 2), (1, 0), (1, None)], ratio("a", "b")) == [
        0.5, None, None]


def test_keywords_are_literal_text(spark):
    data = [("50% off", None), ("50x off", None), ("a_b", None), ("axb", None),
            (None, "MACY'S"), (None, None)]
    got = values(spark, "a string, b string", data,
                 keyword_match(["a", "b"], ["50% o", "A_B", "macy's"]))
    assert got == [True, False, True, False, True, False]


def test_holiday_months(spark):
    data = [(date(2024, 11, 22),), (date(2024, 11, 23),), (date(2024, 12, 24),),
            (date(2024, 12, 25),), (date(2024, 10, 31),)]
    cond = month_filter("d", include=[11, 12], exclude_range=("11-23", "12-24"))
    assert values(spark, "d date", data, cond) == [True, False, False, True, False]


def test_normalise_and_split(spark):
    assert values(spark, "c string", [("TJ Maxx One",)],
                  normalise("c", lower=True, hyphenate=True)) == ["tj-maxx-one"]
    assert values(spark, "c string", [("a, b,,c",), ("",), (None,)], split_list("c")) == [
        ["a", "b", "c"], [], None]


def test_maps(spark):
    got = values(spark, "a string, b string", [("10", "60"), (None, "")],
                 map_text(interest_map([("a", "x"), ("b", "y")])))
    assert got == ["x=1", ""]
    assert values(spark, "k string, v int", [("NY", 5), (None, 5), ("NY", None)],
                  dynamic_map("k", "v")) == [{"NY": 5}, None, None]
    got = values(spark, "c string", [("0-3, 10-12",), ("",), (None,)],
                 list_membership_map("c", [label for _, label in codes.CHILD_AGE_FIELDS]))
    assert got == [{"0-3": 1, "10-12": 1}, None, None]


def test_flag_and_tags(spark):
    assert values(spark, "c string", [("1Y",), ("5N",), (None,)],
                  flag("c", codes.PRESENT_CODES), flag("c", codes.PRESENT_CODES, 0)) == [
        (1, 1), (None, 0), (None, 0)]
    assert values(spark, "a string, b string", [("Y", ""), (None, "1")],
                  tag_array([("a", "p"), ("b", "q")])) == [["p"], ["q"]]
