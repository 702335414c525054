"""Typed catalog of the input tables, with a comment per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(),
          "date": T.DateType(), "timestamp": T.TimestampType(),
          "timestamp_ntz": T.TimestampNTZType(),
          "array<string>": T.ArrayType(T.StringType())}


def struct(columns: Sequence[tuple]) -> T.StructType:
    """Schema from (name, type[, comment]) tuples."""
    out = T.StructType()
    for name, kind, *comment in columns:
        out.add(name, _TYPES[kind], True, {"comment": comment[0]} if comment else None)
    return out


# columns in the order of the delivered files; time of day stays text, HH:mm:ss
TABLES: dict[str, T.StructType] = {
    "transaction": struct([
        ("txid", "string", "Transaction identifier"),
        ("mtid", "string", "Merchant terminal of the transaction"),
        ("membccid", "string", "Card used"),
        ("trans_date", "date", "Authorisation date"),
        ("trans_time", "string", "Time of day, HH:mm:ss"),
        ("trans_time_zone", "string", "Zone of the time, if known"),
        ("trans_amount", "double", "Amount in US dollars"),
        ("delivery_date", "date", "Date the row was delivered")]),
    "card": struct([
        ("membccid", "string", "Card identifier"),
        ("card_zip", "string", "Latest zip code of the card"),
        ("card_type", "string", "Latest type code of the card"),
        ("areaid", "string", "Card portfolio"),
        ("individual_id", "string", "Person who owns the card, if known"),
        ("delivery_date", "date", "Date the row was delivered")]),
    "merchant": struct([
        ("mtid", "string", "Merchant terminal"),
        ("merch_desc", "string", "Description of the merchant"),
        ("mcc", "string", "Four-digit merchant category code"),
        ("merch_city", "string", "City"), ("merch_state", "string", "State"),
        ("merch_zip", "string", "Five-digit zip code"),
        ("merch_country", "string", "Country code"),
        ("delivery_date", "date", "Date the row was delivered")]),
    "brand_tagging": struct([
        ("mtid", "string", "Merchant terminal"), ("store_id", "int", "Store of the brand"),
        ("brand_id", "int", "Brand"), ("channel", "string", "ONLINE or B&M"),
        ("locationid", "string", "Store location")]),
    "brand_taxonomy": struct([
        ("store_id", "int", "Store of the brand"), ("brand_id", "int", "Brand"),
        ("store_name", "string", "Store name"), ("brand_name", "string", "Brand name"),
        ("store_type", "string", "Store type"), ("brand_type", "string", "Brand type"),
        ("brand_tagging_classification", "int", "1 = checked by a person, 0 = machine only")]),
    "brand_location": struct([
        ("locationid", "string", "Store location"), ("address", "string", "Street address"),
        ("city", "string", "City"), ("state", "string", "State"), ("zip", "string", "Zip code"),
        ("country", "string", "Country"), ("est_open_date", "string", "Estimated opening date"),
        ("est_close_date", "string", "Estimated closing date")]),
    "demographics_transactions": struct([
        ("membccid", "string", "Card identifier"), ("income", "string", "Income range"),
        ("wealth", "int", "Predicted net worth"), ("ethnicity", "string", "Ethnicity"),
        ("politics", "string", "Political affiliation"),
        ("adults_in_hh", "string", "Adults in the household"), ("age", "string", "Age group"),
        ("business_owner", "string", "Owns a business"),
        ("children", "string", "Children in the household"),
        ("homeowner_probability", "string", "Owner or renter"), ("gender", "string", "Gender")]),
    "experiment_ids": struct([("individual_id", "string", "Person in the experiment arm")]),
    "audience_lookup": struct([
        ("individual_id", "string", "Member"), ("audience_id", "string", "Audience"),
        ("ver", "int", "Audience version")]),
    "audience_metadata": struct([
        ("audience_id", "string", "Audience"), ("ver", "int", "Audience version")]),
    "audience_config": struct([
        ("audience_id", "string", "Audience"), ("name", "string", "Label in reports"),
        ("brand_keywords", "array<string>", "Keywords that identify the brand"),
        ("date_start", "date", "First day of the holdout window"),
        ("date_end", "date", "Day after the holdout window")]),
}

#: spine columns that are real dates; every other spine column is text
SPINE_DATES = ("yearofbirth_1",)


#: what the columns of the stored products hold; families of columns follow from their names, see comment_of
COLUMN_COMMENTS = {
    **{f.name: f.metadata["comment"] for table in TABLES.values() for f in table.fields if f.metadata},
    "individual_id": "Person", "household_id": "Household of the person", "partition_date": "Date of the person's latest activity",
    "trans_month": "Month of the date, yyyy-MM; folder of the table", "experiment_group": "CONTROL, EXPOSED or NULL outside the experiment",
    "transaction_delivery_date": "Date the transaction was delivered", "merchant_description": "Description of the merchant",
    "merchant_category_code": "Four-digit merchant category code", "transaction_channel": "ONLINE or B&M",
    "transaction_count": "Transactions of the person on the day", "total_transaction_amount": "Sum of the day's amounts",
    "avg_transaction_amount": "Mean of the day's amounts", "min_transaction_amount": "Least amount of the day",
    "max_transaction_amount": "Greatest amount of the day", "latest_delivery_date": "Latest delivery of the day's transactions",
    "earliest_delivery_date": "Earliest delivery of the day's transactions", "unique_merchant_count": "Different terminals of the day",
    "unique_store_count": "Different stores of the day", "unique_brand_count": "Different brands of the day",
    "unique_mcc_count": "Different category codes of the day", "unique_channel_count": "Different channels of the day",
    "rfm_ref_date": "Day the look-back windows end on", "last_txn_date": "Latest transaction up to that day",
    "days_since_last_txn": "Days from the latest transaction to that day", "age": "Age in years", "age_bucket": "Age group",
    "age_bucket_detailed": "Code of the finer age group", "gender": "Gender", "ethnicity": "Ethnic group",
    "ethnicity_prediction": "Ethnic group", "education_level": "Highest education", "education": "Class of education",
    "education_model": "Modelled education", "marital_status": "Marital status", "occupation": "Occupation",
    "occupation_model": "Modelled occupation", "homeowner_status": "Owner or renter", "homeowner": "1 for owners",
    "income_bucket": "Income group", "income": "Income", "household_income_k": "Income in thousands of dollars",
    "net_worth_bucket": "Net worth group", "financial_health_bucket": "Financial health group", "politics": "Political leaning",
    "business_owner": "Owns a business", "state": "State", "zip_code": "Zip code", "city": "City", "weight": "Weight, always 1",
    "adults_in_hh": "Adults in the household", "number_of_children": "Children in the household",
    "num_people_in_household_group": "People in the household", "presence_of_children": "Whether there are children",
    "child_age_group": "Age groups of the children", "investment_type": "Likeliest kind of investment",
    "median_home_value_by_state": "Home value by state", "credit_card_info": "Cards the person likely holds",
}


def comment_of(column: str) -> str:
    """Comment of a product column: its own, or that of its family."""
    if column in COLUMN_COMMENTS:
        return COLUMN_COMMENTS[column]
    words = column.replace("_", " ")
    if column.endswith("_str_list"):
        return f"Different values of {words[:-9]} on the day, if more than one, in ascending order"
    if column[-2:] == "mo" and column.rsplit("_", 1)[-1][:-2].isdigit():
        return f"{words.rsplit(' ', 1)[0].capitalize()} in the {column.rsplit('_', 1)[-1][:-2]} months before the reference date"
    for prefix, meaning in (("merchant_", "Merchant"), ("store_", "Store"), ("brand_", "Brand"), ("media_", "Media use"),
                            ("card_", "Card")):
        if column.startswith(prefix):
            return f"{meaning}: {words[len(prefix):]}"
    return f"{words.capitalize()}{', as a map or list of tags' if column.endswith('_interests') else ''}"


def spine_comment(column: str) -> str:
    """What a spine column feeds."""
    from cohortry.functions import codes
    fed = [out for out, src, *_ in codes.DECODED_FIELDS if src == column]
    fed += [out for out, src in codes.CARRIED_FIELDS.items() if src == column]
    return f"Delivered value of {', '.join(fed)}" if fed else "Delivered value, read by the person dimension"


def spine_schema(id_col: str = "individual_id", extra: Sequence[str] = ()) -> T.StructType:
    """Schema of the demographic spine: the columns the dimension reads, plus any others named.

    The delivered files hold several hundred more; matching by name leaves those unread.
    """
    from cohortry.plans.attributes import source_columns
    names = list(dict.fromkeys([*source_columns(id_col), *extra]))
    return struct([(n, "date" if n in SPINE_DATES else "string", spine_comment(n)) for n in names])


def load_columns(table: str) -> list[str]:
    return TABLES[table].fieldNames()


def with_comments(df: DataFrame, comments: Mapping[str, str] | None = None) -> DataFrame:
    """Attaches column comments, those of the products by default; they are stored with the table, in its files
    and in the catalog, and shown by DESCRIBE."""
    for name, comment in ({c: comment_of(c) for c in df.columns} if comments is None else comments).items():
        df = df.withMetadata(name, {"comment": comment})
    return df
