"""Dresses the sample star schema as the domain tables.

Each table is one list of SQL expressions valid in Spark and in DuckDB, so both engines get the same
input.  NULLs, blanks, misses and repeated ids are part of the dressing; no source row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortry.functions import codes
from cohortry.sources import spread

HOLDOUT = ("2001-07-01", "2001-08-01")
AS_OF = "2001-08-01"
KEYWORDS = ["RING"]


def pick(expr: str, values, null_slot: bool = True) -> str:
    """Cycles an integer expression through ``values`` (and NULL)."""
    n = len(values) + null_slot
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE ({expr}) % {n} {whens} END"


def percentile(i: int, scale: int = 99) -> str:
    """Text 1..scale, blank for one person in eleven."""
    return (f"CASE WHEN (c_custkey + {i}) % 11 = 0 THEN '' "
            f"ELSE CAST((c_custkey * {2 * i + 7} + {i}) % {scale} + 1 AS STRING) END")


def media_flag(i: int) -> str:
    return f"CASE (c_custkey + {i}) % {3 + i % 4} WHEN 0 THEN 'Y' WHEN 1 THEN '' END"


TX = {
    "txid": "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
    "mtid": "CAST(l_partkey AS STRING)",
    "membccid": "CAST(o_custkey AS STRING)",
    "trans_date": "CAST(o_orderdate AS DATE)",
    "trans_time": "'12:' || lpad(CAST(l_linenumber * 7 AS STRING), 2, '0') || ':00'",
    "trans_time_zone": "o_orderpriority",
    "trans_amount": "CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * "
                    "(CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))), 2) "
                    "AS DECIMAL(18,2))",
    "delivery_date": "CAST(l_shipdate AS DATE)",
}
CARD = {
    "membccid": "CAST(c_custkey AS STRING)",
    "card_zip": "CAST(c_nationkey AS STRING)",
    "card_type": "c_mktsegment",
    "areaid": "'A' || CAST(c_custkey % 7 AS STRING)",
    "individual_id": "CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE CAST(c_custkey AS STRING) END",
    "delivery_date": f"CAST('{AS_OF}' AS DATE)",
}
MERCHANT = {  # one terminal in seventeen is unknown to the merchant table
    "mtid": "CASE WHEN p_partkey % 17 = 0 THEN 'closed-' ELSE '' END || CAST(p_partkey AS STRING)",
    "merch_desc": "upper(p_name) || ' ' || CAST(p_size AS STRING)",
    "mcc": "lpad(CAST(p_size * 37 AS STRING), 4, '0')",
    "merch_city": "'CITY ' || CAST(p_partkey % 40 AS STRING)",
    "merch_state": "r_name",
    "merch_zip": "lpad(CAST(p_partkey % 90000 AS STRING), 5, '0')",
    "merch_country": "n_name",
    "delivery_date": f"CAST('{AS_OF}' AS DATE)",
}
TAGGING = {
    "mtid": "CAST(p_partkey AS STRING)",
    "store_id": "CAST(p_partkey AS INT)",
    "brand_id": "CAST(substr(p_brand, 7) AS INT)",
    "channel": "CASE WHEN p_size <= 15 THEN 'ONLINE' ELSE 'B&M' END",
    "locationid": "CAST(p_partkey % 100 AS STRING)",
}
TAXONOMY = {
    "store_id": "CAST(p_partkey AS INT)",
    "brand_id": "CAST(substr(p_brand, 7) AS INT)",
    "store_name": "p_name",
    "brand_name": "p_brand",
    "store_type": "p_type",
    "brand_type": "CASE WHEN p_size % 2 = 0 THEN 'D' ELSE 'P' END",
    "brand_tagging_classification": "CAST(p_partkey % 2 AS INT)",
}
LOCATION = {
    "locationid": "CAST(s_suppkey AS STRING)",
    "address": "s_name", "city": "n_name", "state": "r_name",
    "zip": "lpad(CAST(s_suppkey AS STRING), 5, '0')",
    "country": "'US'", "est_open_date": "'1990-01-01'", "est_close_date": "CAST(NULL AS STRING)",
}


def _spine() -> dict[str, str]:
    k = "c_custkey"
    out = {
        "individual_id": f"CAST({k} AS STRING)",
        "lu_a_adat": pick(k, ["20010731", "2001", "20010630"]),
        "combined_age_1": f"CASE WHEN {k} % 13 = 0 THEN '' WHEN {k} % 17 = 0 THEN 'E' "
                          f"ELSE 'E' || CAST(18 + {k} % 60 AS STRING) END",
        "yearofbirth_1": "CAST('1960-01-01' AS DATE)",
        "ocup_model_v2_1": pick(k, [*codes.OCCUPATION_MODEL, "Q7"]),
        "lu_inc_model_v6_amt": f"CASE {k} % 7 WHEN 0 THEN '000' WHEN 1 THEN ' ' "
                               f"ELSE lpad(CAST(1 + ({k} * 3) % 250 AS STRING), 3, '0') END",
        "rec_adultcnt": f"CASE {k} % 9 WHEN 0 THEN NULL WHEN 1 THEN '' "
                        f"ELSE CAST({k} % 6 AS STRING) END",
        "rec_childcnt": f"CAST({k} % 4 AS STRING)",
        "rec_perscnt": f"CAST({k} % 8 AS STRING)",
        "pocv4_code": pick(k, ["1Y", "5Y", "5N", "5U", "00"]),
        "c20_cyemhuval": f"CASE WHEN {k} % 19 = 0 THEN NULL "
                         f"ELSE CAST(({k} * 371) % 900000 AS STRING) END",
        "stat_abbr": f"CASE WHEN {k} % 29 = 0 THEN NULL ELSE n_name END",
        "recd_zipc": f"lpad(CAST({k} % 90000 AS STRING), 5, '0')",
        "city_plac": f"'Old Town ' || CAST({k} % 23 AS STRING)",
        "geo_cntyname": f"'COUNTY ' || CAST({k} % 31 AS STRING)",
        "cbsa_code": f"CAST(10000 + {k} % 900 AS STRING)",
        "cbsa_type": pick(k, ["A", "B", "C"]),
        "metro_flag": pick(k, ["Y", "N"]),
    }
    for i, (_, src, mapping, _) in enumerate(codes.DECODED_FIELDS):
        # every known code, one unknown, and NULL; the step decorrelates the fields
        out.setdefault(src, pick(f"{k} * {2 * i + 1} + {i}", [*mapping, "?"]))
    for i, (src, _) in enumerate(codes.CHILD_AGE_FIELDS):
        out[src] = pick(f"{k} + {i}", ["1Y", "5N", "5Y", "5U", "00"])
    scale = {src: s for _, src, _, s in codes.CREDIT_CARDS}
    brands = {src for _, src, tags in codes.MEDIA_FIELDS}
    for i, src in enumerate(codes.CARRIED_FIELDS.values()):
        media = src in brands and not src.startswith("act_int")
        out.setdefault(src, media_flag(i) if media else percentile(i, scale.get(src, 99)))
    return out


SPINE = _spine()

CONTROL_IDS = "SELECT CAST(c_custkey AS STRING) AS individual_id FROM customer " \
              "WHERE c_mktsegment = 'HOUSEHOLD'"
EXPOSED_IDS = "SELECT CAST(c_custkey AS STRING) AS individual_id FROM customer " \
              "WHERE c_mktsegment IN ('HOUSEHOLD', 'MACHINERY')"

FROM = {
    "tx": "lineitem JOIN orders ON l_orderkey = o_orderkey",
    "card": "customer",
    "merchant": "part JOIN nation ON n_nationkey = p_partkey % 25 "
                "JOIN region ON r_regionkey = n_regionkey",
    "tagging": "part", "taxonomy": "part",
    "location": "supplier JOIN nation ON s_nationkey = n_nationkey "
                "JOIN region ON n_regionkey = r_regionkey",
    "spine": "customer JOIN nation ON c_nationkey = n_nationkey",
}
COLUMNS = {"tx": TX, "card": CARD, "merchant": MERCHANT, "tagging": TAGGING, "taxonomy": TAXONOMY,
           "location": LOCATION, "spine": SPINE}
SPINE_ROWS = 50_000
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
#: delivered beside them; here they are only counted
TEXT_TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# audiences: one per region, members by account balance; the last region has no members
LOOKUP = (
    "SELECT CAST(c_custkey AS STRING) AS individual_id, 'aud_' || lower(r_name) AS audience_id, "
    "v.ver AS ver FROM customer JOIN nation ON c_nationkey = n_nationkey "
    "JOIN region ON n_regionkey = r_regionkey "
    "JOIN (SELECT 1 AS ver, 5000 AS floor_ UNION ALL SELECT 2, 7000) v ON c_acctbal > v.floor_ "
    "WHERE r_name <> 'MIDDLE EAST'")
METADATA = (
    "SELECT 'aud_' || lower(r_name) AS audience_id, v.ver AS ver FROM region "
    "JOIN (SELECT 1 AS ver UNION ALL SELECT 2) v ON v.ver = 1 OR r_name <> 'ASIA'")
CONFIG_DEFAULTS = {"date_start": HOLDOUT[0], "date_end": HOLDOUT[1]}
CONFIG_ENTRIES = (
    "SELECT 'aud_' || lower(r_name) AS audience_id, 'Shoppers in ' || r_name AS name, "
    "CASE r_name WHEN 'AMERICA' THEN 'WIDGET,Bolt' WHEN 'ASIA' THEN 'Gear' ELSE 'Ring' END "
    "AS keywords, CASE r_name WHEN 'EUROPE' THEN '2001-06-01' END AS date_start, "
    "CASE r_name WHEN 'EUROPE' THEN '2001-07-01' END AS date_end FROM region")

# many audiences: one per brand and fortieth of the terminals; a customer belongs to one, a fortieth has no window
MANY_CONFIG = (
    "SELECT 'many_' || p_brand || '_' || CAST(p_partkey % 40 AS STRING) AS audience_id, "
    "p_brand || ' no. ' || CAST(p_partkey % 40 AS STRING) AS name, p_brand AS word1, min(p_name) AS word2, "
    "substr(max(p_name), 3) AS word3, upper(min(p_name)) || ' ' || CAST(max(p_size) AS STRING) AS word4, "
    "'nothing ' || p_brand AS word5, '2001-0' || CAST(4 + p_partkey % 4 AS STRING) || '-01' AS date_start, "
    "CASE WHEN p_partkey % 40 = 39 THEN '2001-01-01' ELSE '2001-0' || CAST(5 + p_partkey % 4 AS STRING) || '-01' "
    "END AS date_end FROM part GROUP BY p_brand, p_partkey % 40, p_partkey % 4")
MANY_LOOKUP = (
    "SELECT CAST(c_custkey AS STRING) AS individual_id, 'many_' || p_brand || '_' || CAST(c_custkey % 40 AS STRING) "
    "AS audience_id, 1 AS ver FROM customer JOIN (SELECT DISTINCT p_brand FROM part) b "
    "ON c_nationkey + 1 = CAST(substr(p_brand, 7) AS INT)")


def select_sql(table: str) -> str:
    items = ", ".join(f"{e} AS {n}" for n, e in COLUMNS[table].items())
    return f"SELECT {items} FROM {FROM[table]}"


class Domain:
    """The domain tables over one data folder, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self.raw = {}
        self.latest = None

    def table(self, name: str) -> DataFrame:
        if name not in self.raw:
            df = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
            # the sample files hold a single row group each
            self.raw[name] = spread(df, "l_orderkey") if name == "lineitem" else df
        return self.raw[name]

    def sql(self, text: str, **given: DataFrame) -> DataFrame:
        used = {t: given[t] if t in given else self.table(t) for t in TABLES if t in text}
        for t in used:
            text = text.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t} ", f"JOIN {{{t}}} ")
        return self.spark.sql(text, **used)

    def __getattr__(self, name: str) -> DataFrame:
        if name in COLUMNS:
            return self.sql(select_sql(name))
        raise AttributeError(name)

    @property
    def spine(self) -> DataFrame:
        """A customer is a few bytes in the file and a record of some 2 KB here, so few go into a task.  All
        columns deal them out: keys may be missing or repeated."""
        people = self.table("customer")
        return self.sql(select_sql("spine"), customer=spread(people, *people.columns, task_rows=SPINE_ROWS))

    @property
    def control(self) -> DataFrame:  # every id twice
        return self.sql(CONTROL_IDS).union(self.sql(CONTROL_IDS))

    @property
    def exposed(self) -> DataFrame:
        return self.sql(EXPOSED_IDS).union(self.sql(EXPOSED_IDS))

    @property
    def lookup(self) -> DataFrame:
        return self.sql(LOOKUP)

    @property
    def metadata(self) -> DataFrame:
        return self.sql(METADATA)
