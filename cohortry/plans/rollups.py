"""Person, household and media rollups of the person dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.functions import (age_code, argmin_label, codes, decode, dynamic_map, flag, flag_map,
                                income_code, interest_map, likely, list_membership_map)
from cohortry.operators import tag_count_maps, tags_long


def _coarse_codes(index: int, strict: bool) -> dict:
    out = {label: pair[index] for label, pair in codes.AGE_CODES.items()}
    if not strict:  # the dimension labels the youngest bucket 18-24; strict mode leaves it at 0
        out["18-24"] = 1
    return out


def _tags(fields) -> list[tuple]:
    return [(out, tag) for out, _, tag in fields if tag]


def person_rollup(attrs: DataFrame, id_col: str = "individual_id",
                  strict_reference: bool = False) -> DataFrame:
    """Person-level recodes and interest maps, a pure projection (no shuffle).

    ``strict_reference=True`` gives ages 18 to 24 the code 0, as a literal reading of the published
    bucket labels does; by default they get their documented code 1.
    """
    def age(index, senior):
        return age_code("age_bucket", "age", _coarse_codes(index, strict_reference), senior)
    return attrs.select(
        id_col, "household_id", F.lit(1).alias("weight"),
        decode("gender", codes.GENDER_LETTER, "UNDETERMINED").alias("gender"),
        "zip_code", "age",
        age(0, codes.SENIOR_COARSE).alias("age_bucket"),
        age(1, codes.SENIOR_DETAILED).alias("age_bucket_detailed"),
        F.col("ethnicity").alias("ethnicity_prediction"),
        decode("education_level", codes.EDUCATION_CLASS, "Unknown").alias("education"),
        "marital_status", "state", "occupation",
        *[F.lit(0).alias(n) for n in ("emails", "maids", "phones", "ips")],
        interest_map(_tags(codes.GENERAL_INTERESTS)).alias("general_interests"),
        interest_map(_tags(codes.SPORTS_INTERESTS)).alias("sports_interests"),
        interest_map(_tags(codes.READING_INTERESTS)).alias("reading_interests"),
        flag_map([(c, t, 99) for c, t in _tags(codes.TRAVEL_INTERESTS)]).alias("travel_interests"),
        decode("financial_health_bucket", codes.FINANCIAL_HEALTH_CODE)
        .alias("financial_health_bucket"),
        decode("net_worth_bucket", codes.NET_WORTH_LETTER, "Unknown").alias("net_worth_bucket"),
        flag_map([(c, t, scale) for c, _, t, scale in codes.CREDIT_CARDS])
        .alias("credit_card_info"),
        argmin_label(codes.INVESTMENT_LABELS).alias("investment_type"),
        "partition_date")


def household_rollup(attrs: DataFrame, strict_reference: bool = False) -> DataFrame:
    """Household-level recodes, a pure projection.

    The income amount is stored in dollars while the splits are stated in thousands:
    ``strict_reference=True`` compares them as they are, the default converts the split.
    """
    children = [label for _, label in codes.CHILD_AGE_FIELDS]
    return attrs.select(
        "partition_date", "household_id", F.col("household_income_k").alias("income"),
        income_code("income_bucket", "household_income_k", codes.INCOME_CODES,
                    codes.INCOME_CODE_UNKNOWN, 1 if strict_reference else 1000)
        .alias("income_bucket"),
        list_membership_map("child_age_group", children).alias("child_age_group"),
        flag("homeowner_status", ["HOMEOWNER"], 0).alias("homeowner"),
        "number_of_children", flag("presence_of_children", [1], 0).alias("presence_of_children"),
        F.col("num_people_in_household_group").alias("num_people_in_household"),
        "num_people_in_household_group",
        dynamic_map("state", "median_home_value_by_state").alias("median_home_value_by_state"),
        F.lit(1).alias("hh_weight"))


def media_long(attrs: DataFrame, id_col: str = "individual_id") -> DataFrame:
    """One row per (person, date, type, tag) that is filled."""
    return tags_long(attrs.where(F.col("partition_date").isNotNull()),
                     [id_col, "partition_date"], codes.MEDIA_TAGS)


def media_rollup(attrs: DataFrame, id_col: str = "individual_id", unique_keys: bool = False,
                 threshold: int | None = None) -> DataFrame:
    """Five ``{tag: count}`` maps per (person, date); people without any tag have no row.

    A type without tags is an empty map.  Any filled field counts; ``threshold=50`` instead asks for
    a likely percentile on the 1-99 fields.  ``unique_keys=True`` (one attribute row per person and
    date) makes the rollup a projection without a shuffle.
    """
    present = None if threshold is None else lambda c: likely(c) if "_brand_" not in c \
        else F.coalesce(F.col(c) != "", F.lit(False))
    keys = [id_col, "partition_date"]
    out = tag_count_maps(attrs.where(F.col("partition_date").isNotNull()), keys, codes.MEDIA_TAGS,
                         codes.MEDIA_COLUMNS, unique_keys, present)
    return out.withColumn("media_weight", F.lit(1))
