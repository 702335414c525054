"""The decoded person dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.functions import (bucket, codes, decode, flag, income_amount, int_or_zero, parse_age,
                                parse_yyyymmdd)
from cohortry.operators import label_membership

OCCUPATION_MODEL_SOURCE = "ocup_model_v2_1"


def source_columns(id_col: str) -> list[str]:
    """Every spine column the dimension reads."""
    plain = ["lu_a_adat", "combined_age_1", "yearofbirth_1", OCCUPATION_MODEL_SOURCE,
             "lu_inc_model_v6_amt", "rec_adultcnt", "rec_childcnt", "rec_perscnt", "pocv4_code",
             "c20_cyemhuval"]
    return list(dict.fromkeys(
        [id_col, *plain, *[src for _, src, _, _ in codes.DECODED_FIELDS],
         *[src for src, _ in codes.CHILD_AGE_FIELDS], *codes.GEOGRAPHY_FIELDS.values(),
         *codes.CARRIED_FIELDS.values()]))


def child_age_group():
    """Comma-separated age groups with a child present; NULL when there is none."""
    present = [F.when(F.col(src).isin(*codes.PRESENT_CODES), F.lit(label))
               for src, label in codes.CHILD_AGE_FIELDS]
    return F.nullif(F.concat_ws(", ", *present), F.lit(""))


def person_attributes(spine: DataFrame, control: DataFrame | None = None,
                      exposed: DataFrame | None = None, *, as_of,
                      id_col: str = "individual_id", out_id: str = "individual_id",
                      household_col: str | None = None, dedupe: bool = True,
                      latest_only: bool = False) -> DataFrame:
    """Decoded attributes, one row per distinct spine record (156 columns).

    ``as_of`` stands in for a missing activity date, so a rebuild gives the same rows.  The columns
    used are projected before duplicates are removed.  ``latest_only`` keeps the record of the latest
    date per person; ``household_col`` names a household key (default: the person).
    """
    cols = source_columns(id_col)
    if household_col:
        cols = list(dict.fromkeys(cols + [household_col]))
    rows = spine.select(*cols)
    if dedupe:
        rows = rows.distinct()

    decoded = {out: decode(src, mapping, default)
               for out, src, mapping, default in codes.DECODED_FIELDS}
    age = parse_age("combined_age_1")
    model = F.coalesce(F.col(OCCUPATION_MODEL_SOURCE), F.lit(""))
    geography = {out: F.col(src) for out, src in codes.GEOGRAPHY_FIELDS.items()}
    fields = {
        out_id: F.col(id_col),
        "household_id": F.col(household_col or id_col),
        "partition_date": parse_yyyymmdd("lu_a_adat", as_of),
        "gender": decoded["gender"],
        "age": age,
        "age_bucket": bucket(age, codes.AGE_BOUNDS),
        "year_of_birth": F.col("yearofbirth_1"),
        "ethnicity": decoded["ethnicity"],
        "education_level": decoded["education_level"],
        "education_model": decoded["education_model"],
        "marital_status": decoded["marital_status"],
        "occupation": decoded["occupation"],
        "occupation_model": decode(model, codes.OCCUPATION_MODEL, "UNDETERMINED"),
        "homeowner_status": decoded["homeowner_status"],
        "household_income_k": income_amount("lu_inc_model_v6_amt"),
        "income_bucket": decoded["income_bucket"],
        "net_worth_bucket": decoded["net_worth_bucket"],
        "financial_health_bucket": decoded["financial_health_bucket"],
        "politics": decoded["politics"],
        "business_owner": decoded["business_owner"],
        "adults_in_hh": int_or_zero("rec_adultcnt"),
        "number_of_children": int_or_zero("rec_childcnt"),
        "num_people_in_household_group": int_or_zero("rec_perscnt"),
        "presence_of_children": flag("pocv4_code", codes.PRESENT_CODES),
        "child_age_group": child_age_group(),
        **geography,
        "market_area_type": decoded["market_area_type"],
        "median_home_value_by_state": int_or_zero("c20_cyemhuval"),
        **{out: F.col(src) for out, src in codes.CARRIED_FIELDS.items()},
    }
    people = rows.select(*[c.alias(n) for n, c in fields.items()])
    if latest_only:
        rest = F.struct("partition_date", *[c for c in people.columns
                                            if c not in (out_id, "partition_date")])
        people = people.groupBy(out_id).agg(F.max(rest).alias("_r")).select(out_id, "_r.*") \
            .select(*people.columns)
    lists = [(label, ids) for label, ids in (("CONTROL", control), ("EXPOSED", exposed))
             if ids is not None]
    return label_membership(people, out_id, lists, "experiment_group")
