"""The same queries as plain SQL, written the direct way (row-wise CASE, joins, COUNT DISTINCT)."""

from __future__ import annotations

from cohortry.functions import codes
from cohortry.plans.enrich import LOCATION, MERCHANT, TAXONOMY
from cohortry.plans.rules import RULES
from cohortry.plans.summary import DISTINCT_COLUMNS, LIST_COLUMNS, MODE_COLUMNS
from cohortry.schemas import comment_of

from . import adapters as A

NAMES = ("brand_name", "store_name", "merchant_description")
D0, D1 = A.HOLDOUT


def case(col: str, mapping, default) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {'NULL' if default is None else repr(default)} END"


def text(*cols: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in cols)


def big(*cols: str) -> str:
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in cols)


def dbl(*cols: str) -> str:
    return ", ".join(f"ROUND(CAST({c} AS DOUBLE), 6) AS {c}" for c in cols)


def likely(col: str, scale: int = 99) -> str:
    rule = "<= 5" if scale == 10 else "< 50"
    return f"COALESCE(TRY_CAST({col} AS INT) {rule}, FALSE)"


def joined(items: list[str], sep: str = ",") -> str:
    return f"COALESCE(list_aggregate(list_sort([{', '.join(items)}]), 'string_agg', '{sep}'), '')"


def present_map(pairs, scale=99) -> str:
    return joined([f"CASE WHEN {likely(c, scale)} THEN '{t}=1' END" for c, t in pairs])


def flag_map(triples) -> str:
    return joined([f"'{t}=' || CASE WHEN {likely(c, s)} THEN '1' ELSE '0' END"
                   for c, t, s in triples])


def brand(keywords, alias="") -> str:
    return "(" + " OR ".join(f"contains(upper({alias}{c}), '{k.upper()}')"
                             for k in keywords for c in NAMES) + ")"


# --- shared building blocks --------------------------------------------------------------------
FACT_COLUMNS = (
    ["txid", "trans_date", "trans_time", "trans_time_zone", "trans_amount",
     "transaction_delivery_date", "individual_id", "membccid", "card_type", "card_zip", "areaid",
     "mtid", *MERCHANT.values(), "store_id", "brand_id", "transaction_channel", "locationid",
     *TAXONOMY, *LOCATION.values(), "experiment_group"])

FACT = f"""
tx AS ({A.select_sql('tx')}), card AS ({A.select_sql('card')}),
merchant AS ({A.select_sql('merchant')}), tagging AS ({A.select_sql('tagging')}),
taxonomy AS ({A.select_sql('taxonomy')}), location AS ({A.select_sql('location')}),
control AS ({A.CONTROL_IDS}), exposed AS ({A.EXPOSED_IDS}),
fact AS (
 SELECT t.txid, t.trans_date, t.trans_time, t.trans_time_zone, t.trans_amount,
  t.delivery_date AS transaction_delivery_date, c.individual_id, t.membccid, c.card_type, c.card_zip,
  c.areaid, m.mtid, {', '.join(f'm.{k} AS {v}' for k, v in MERCHANT.items())},
  b.store_id, b.brand_id, b.channel AS transaction_channel, b.locationid,
  {', '.join(f'x.{c}' for c in TAXONOMY)}, {', '.join(f'l.{k} AS {v}' for k, v in LOCATION.items())},
  CASE WHEN c.individual_id IN (SELECT individual_id FROM control) THEN 'CONTROL'
       WHEN c.individual_id IN (SELECT individual_id FROM exposed) THEN 'EXPOSED' END
  AS experiment_group
 FROM tx t LEFT JOIN card c ON t.membccid = c.membccid LEFT JOIN merchant m ON t.mtid = m.mtid
 LEFT JOIN tagging b ON t.mtid = b.mtid
 LEFT JOIN taxonomy x ON b.store_id = x.store_id AND b.brand_id = x.brand_id
 LEFT JOIN location l ON b.locationid = l.locationid
 WHERE t.trans_date IS NOT NULL),
known AS (SELECT * FROM fact WHERE individual_id IS NOT NULL),
ref AS (SELECT max(trans_date) AS d FROM fact)"""


def fact_row(where: str = "TRUE") -> str:
    dates = ("trans_date", "transaction_delivery_date")
    ints = ("store_id", "brand_id", "brand_tagging_classification")
    items = [text(c) if c in dates else big(c) if c in ints else dbl(c) if c == "trans_amount" else c
             for c in FACT_COLUMNS]
    return f"WITH {FACT} SELECT {', '.join(items)} FROM fact WHERE {where}"


def _attrs() -> str:
    age = "TRY_CAST(substr(combined_age_1, 2) AS INT)"
    buckets = " ".join(f"WHEN {age} >= {lo}" + (f" AND {age} <= {hi}" if hi else "") + f" THEN '{n}'"
                       for lo, hi, n in codes.AGE_BOUNDS)
    children = ", ".join(f"CASE WHEN {src} IN ('1Y', '5Y') THEN '{label}' END"
                         for src, label in codes.CHILD_AGE_FIELDS)

    def count(c):
        return f"COALESCE(TRY_CAST({c} AS INT), 0)"
    fields = {
        "individual_id": "individual_id", "household_id": "individual_id",
        "partition_date": "CASE WHEN length(lu_a_adat) = 8 THEN CAST(substr(lu_a_adat, 1, 4) || '-' "
                          "|| substr(lu_a_adat, 5, 2) || '-' || substr(lu_a_adat, 7, 2) AS DATE) "
                          f"ELSE DATE '{A.AS_OF}' END",
        "age": age, "age_bucket": f"CASE {buckets} END", "year_of_birth": "yearofbirth_1",
        **{out: case(src, m, d) for out, src, m, d in codes.DECODED_FIELDS},
        "occupation_model": case("COALESCE(ocup_model_v2_1, '')", codes.OCCUPATION_MODEL,
                                 "UNDETERMINED"),
        "household_income_k": "CASE WHEN trim(lu_inc_model_v6_amt) NOT IN ('', '000') "
                              "THEN TRY_CAST(trim(lu_inc_model_v6_amt) AS INT) * 1000 END",
        "adults_in_hh": count("rec_adultcnt"), "number_of_children": count("rec_childcnt"),
        "num_people_in_household_group": count("rec_perscnt"),
        "presence_of_children": "CASE WHEN pocv4_code IN ('1Y', '5Y') THEN 1 END",
        "child_age_group": f"NULLIF(concat_ws(', ', {children}), '')",
        **codes.GEOGRAPHY_FIELDS,
        "median_home_value_by_state": count("c20_cyemhuval"),
        **codes.CARRIED_FIELDS,
        "experiment_group": "CASE WHEN individual_id IN (SELECT individual_id FROM control) "
                            "THEN 'CONTROL' WHEN individual_id IN (SELECT individual_id FROM "
                            "exposed) THEN 'EXPOSED' END",
    }
    return ("spine AS (" + A.select_sql("spine") + "), attrs AS (SELECT DISTINCT "
            + ", ".join(f"{e} AS {n}" for n, e in fields.items()) + " FROM spine)"), list(fields)


ATTRS_CTE, ATTR_COLUMNS = _attrs()
ATTRS = f"control AS ({A.CONTROL_IDS}), exposed AS ({A.EXPOSED_IDS}), {ATTRS_CTE}"
ATTR_INTS = ("age", "household_income_k", "adults_in_hh", "number_of_children",
             "num_people_in_household_group", "presence_of_children", "median_home_value_by_state")


def attr_row(*cols: str) -> str:
    items = [text(c) if c in ("partition_date", "year_of_birth") else big(c) if c in ATTR_INTS else c
             for c in (("individual_id", *cols) if cols else ATTR_COLUMNS)]
    return f"WITH {ATTRS} SELECT {', '.join(items)} FROM attrs"


# --- daily summary -----------------------------------------------------------------------------
def _mode(col: str) -> str:
    return (f"mode_{col} AS (SELECT trans_date, individual_id, {col} FROM (SELECT trans_date, "
            f"individual_id, {col}, row_number() OVER (PARTITION BY trans_date, individual_id "
            f"ORDER BY count(*) DESC, {col}) AS rn FROM known WHERE {col} IS NOT NULL "
            f"GROUP BY trans_date, individual_id, {col}) WHERE rn = 1)")


def _list(col: str) -> str:
    return (f"CASE WHEN count(DISTINCT {col}) > 1 THEN array_to_string(list_sort(list(DISTINCT {col}) "
            f"FILTER (WHERE {col} IS NOT NULL)), ',') END")


def daily_summary() -> str:
    modes = ", ".join(_mode(c) for c in MODE_COLUMNS)
    joins = " ".join(f"LEFT JOIN mode_{c} USING (trans_date, individual_id)" for c in MODE_COLUMNS)
    return f"""WITH {FACT}, {modes}, grouped AS (
 SELECT trans_date, individual_id, max(experiment_group) AS experiment_group,
  count(*) AS transaction_count, sum(trans_amount) AS total_transaction_amount,
  avg(trans_amount) AS avg_transaction_amount, min(trans_amount) AS min_transaction_amount,
  max(trans_amount) AS max_transaction_amount, max(transaction_delivery_date) AS latest_delivery_date,
  min(transaction_delivery_date) AS earliest_delivery_date,
  {', '.join(f'{_list(c)} AS {c}_str_list' for c in LIST_COLUMNS)},
  {', '.join(f'count(DISTINCT {c}) AS {n}' for c, n in DISTINCT_COLUMNS.items())}
 FROM known GROUP BY trans_date, individual_id)
 SELECT {text('trans_date')}, individual_id, experiment_group, {big('transaction_count')},
  {dbl('total_transaction_amount')},
  ROUND(CAST(total_transaction_amount AS DOUBLE) / transaction_count, 6) AS avg_transaction_amount,
  {dbl('min_transaction_amount', 'max_transaction_amount')},
  {text('latest_delivery_date', 'earliest_delivery_date')}, {', '.join(MODE_COLUMNS)},
  {', '.join(f'{c}_str_list' for c in LIST_COLUMNS)}, {big(*DISTINCT_COLUMNS.values())}
 FROM grouped {joins}"""


# --- features ----------------------------------------------------------------------------------
def _rfm(ref: str = "(SELECT d FROM ref)") -> str:
    cols = []
    for m in codes.RFM_WINDOWS:
        w = f"trans_date >= {ref} - INTERVAL {m} MONTH"
        on = f"{w} AND transaction_channel = 'ONLINE'"
        n = f"count(CASE WHEN {w} THEN 1 END)"
        cols += [
            f"{n} AS tot_trans_{m}mo",
            f"COALESCE(sum(CASE WHEN {w} THEN trans_amount END), 0) AS tot_spend_{m}mo",
            f"count(CASE WHEN {on} THEN 1 END) AS tot_online_trans_{m}mo",
            f"COALESCE(sum(CASE WHEN {on} THEN trans_amount END), 0) AS tot_online_spend_{m}mo",
            f"CASE WHEN {n} > 1 THEN CAST(date_diff('day', min(CASE WHEN {w} THEN trans_date END), "
            f"max(CASE WHEN {w} THEN trans_date END)) AS DOUBLE) / ({n} - 1) END "
            f"AS avg_days_btwn_trans_{m}mo",
            f"count(DISTINCT CASE WHEN {w} THEN brand_name END) AS brand_diversity_{m}mo"]
    return f"""rfm AS (SELECT individual_id, {ref} AS rfm_ref_date, max(trans_date) AS last_txn_date,
 date_diff('day', max(trans_date), {ref}) AS days_since_last_txn, {', '.join(cols)},
 CAST(count(CASE WHEN transaction_channel = 'ONLINE' THEN 1 END) AS DOUBLE) / count(*)
 AS online_ratio_12mo
 FROM known WHERE trans_date >= {ref} - INTERVAL 12 MONTH AND trans_date <= {ref}
 GROUP BY individual_id)"""


RFM_COLUMNS = [f"{p}_{m}mo" for m in codes.RFM_WINDOWS for p in codes.RFM_METRICS]
RFM_DOUBLES = ("tot_spend", "tot_online_spend", "avg_days", "online_ratio")


def num(c: str) -> str:
    return dbl(c) if c.startswith(RFM_DOUBLES) else big(c)


def rfm_row(ref: str = "(SELECT d FROM ref)") -> str:
    return (f"WITH {FACT}, {_rfm(ref)} SELECT individual_id, {text('rfm_ref_date', 'last_txn_date')},"
            f" {big('days_since_last_txn')}, {', '.join(num(c) for c in RFM_COLUMNS)}, "
            f"{dbl('online_ratio_12mo')} FROM rfm")


def seed(keywords=A.KEYWORDS, months=12, minimum=2, extra="TRUE", ref="(SELECT d FROM ref)") -> str:
    return (f"SELECT individual_id FROM known WHERE {brand(keywords)} AND trans_date >= {ref} - "
            f"INTERVAL {months} MONTH AND trans_date < {ref} + INTERVAL 1 DAY AND {extra} "
            f"GROUP BY individual_id HAVING count(*) >= {minimum}")


ONLINE = "transaction_channel = 'ONLINE'"
HOLIDAY = "month(trans_date) IN (11, 12) AND NOT (strftime(trans_date, '%m-%d') BETWEEN '11-23' " \
          "AND '12-24')"


def seed_grid() -> str:
    cells = []
    for m in codes.SEED_LOOKBACK_MONTHS:
        for k in (1, 2, 3):
            for r in (None, 60):
                screen = "TRUE" if r is None else \
                    f"individual_id IN (SELECT individual_id FROM rfm WHERE days_since_last_txn < {r})"
                cells.append(f"SELECT CAST({m} AS BIGINT) AS lookback_months, CAST({k} AS BIGINT) "
                             f"AS min_transactions, CAST({r or 'NULL'} AS BIGINT) AS max_recency, "
                             f"count(*) AS seed_size FROM ({seed(months=m, minimum=k)}) s "
                             f"WHERE {screen}")
    return f"WITH {FACT}, {_rfm()} " + " UNION ALL ".join(cells)


# --- lookalike ---------------------------------------------------------------------------------
NUM, CAT = codes.NUMERIC_FIELDS, codes.CATEGORICAL_FIELDS
ATTR_NUM = ("age", "household_income_k", "adults_in_hh")


def _pop(base: str = "attrs") -> str:
    other = "rfm" if base == "attrs" else "attrs"
    return f"""{FACT}, {ATTRS_CTE}, {_rfm()}, seed AS ({seed()}),
pop AS (SELECT p.individual_id, CASE WHEN s.individual_id IS NULL THEN 0 ELSE 1 END AS is_seed,
 {', '.join(NUM)}, {', '.join(CAT)} FROM {base} p
 LEFT JOIN {other} o ON p.individual_id = o.individual_id
 LEFT JOIN seed s ON p.individual_id = s.individual_id)"""


def pop_row(base: str) -> str:
    return (f"WITH {_pop(base)} SELECT individual_id, {big('is_seed')}, "
            f"{', '.join(num(c) for c in NUM)}, {', '.join(CAT)} FROM pop")


def _profile() -> str:
    return "profile AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg(CAST({c} AS DOUBLE)) FILTER (WHERE is_seed = 1) AS seed_mean, "
        f"stddev_samp(CAST({c} AS DOUBLE)) FILTER (WHERE is_seed = 1) AS seed_std, "
        f"avg(CAST({c} AS DOUBLE)) AS pop_mean, stddev_samp(CAST({c} AS DOUBLE)) AS pop_std FROM pop"
        for c in NUM) + ")"


def _shares() -> str:
    long = " UNION ALL ".join(f"SELECT '{c}' AS field, {c} AS value, is_seed FROM pop "
                              f"WHERE {c} IS NOT NULL" for c in CAT)
    return f"""long AS ({long}), counted AS (SELECT field, value, sum(is_seed) AS seed_count,
 count(*) AS pop_count FROM long GROUP BY field, value),
shares AS (SELECT field, value, seed_count, pop_count,
 CASE WHEN seed_count > 0 THEN CAST(seed_count AS DOUBLE) / sum(seed_count) OVER (PARTITION BY field)
 END AS seed_share, CAST(pop_count AS DOUBLE) / sum(pop_count) OVER (PARTITION BY field) AS pop_share
 FROM counted),
importance AS (SELECT field, greatest(COALESCE(max(seed_share / pop_share), 0), 0.1) AS importance
 FROM shares GROUP BY field)"""


def _scored() -> str:
    terms = []
    for c in NUM:
        def stat(name, c=c):
            return f"(SELECT {name} FROM profile WHERE feature = '{c}')"
        width = f"greatest(COALESCE({stat('seed_std')}, 0), 0.5 * {stat('pop_std')})"
        weight = f"greatest(abs({stat('seed_mean')} - {stat('pop_mean')}) / {stat('pop_std')}, 0.1)"
        terms.append(f"CASE WHEN COALESCE({stat('pop_std')}, 0) = 0 THEN 0 ELSE COALESCE(exp(-0.5 * "
                     f"pow((CAST({c} AS DOUBLE) - {stat('seed_mean')}) / {width}, 2)) * {weight}, 0)"
                     " END")
    cats = [f"COALESCE((SELECT seed_share FROM shares s WHERE s.field = '{c}' AND s.value = pop.{c}), "
            f"0) * (SELECT importance FROM importance WHERE field = '{c}')" for c in CAT]
    return f"""{_pop()}, {_profile()}, {_shares()},
parts AS (SELECT individual_id, is_seed, {' + '.join(terms)} AS numeric_similarity_score,
 {' + '.join(cats)} AS categorical_similarity_score FROM pop
 WHERE (SELECT count(*) FROM pop WHERE is_seed = 1) > 0),
scored AS (SELECT *, numeric_similarity_score + categorical_similarity_score AS similarity_score
 FROM parts),
board AS (SELECT individual_id, is_seed, numeric_similarity_score, categorical_similarity_score, ROUND(similarity_score, 6) AS similarity_score,
 row_number() OVER (ORDER BY ROUND(similarity_score, 6) DESC, individual_id) AS rn FROM scored)"""


TOP_N = f"WITH {_scored()} SELECT individual_id, {big('is_seed')}, similarity_score FROM board " \
        "WHERE rn <= 500"


RANKED = f"WITH {_scored()} SELECT individual_id, {big('is_seed')}, " + dbl(
    "numeric_similarity_score", "categorical_similarity_score") + ", similarity_score, rn AS rank FROM board WHERE rn <= "


# --- audiences ---------------------------------------------------------------------------------
CONFIG = f"""entries AS ({A.CONFIG_ENTRIES}), config AS (SELECT audience_id, name, keywords,
 CAST(COALESCE(date_start, '{D0}') AS DATE) AS date_start,
 CAST(COALESCE(date_end, '{D1}') AS DATE) AS date_end FROM entries)"""
LATEST = f"""lookup AS ({A.LOOKUP}), metadata AS ({A.METADATA}),
latest AS (SELECT l.* FROM lookup l JOIN (SELECT audience_id, max(ver) AS ver FROM metadata
 GROUP BY audience_id) m ON l.audience_id = m.audience_id AND l.ver = m.ver)"""
RATES = """
 CASE WHEN active > 0 THEN CAST(shoppers AS DOUBLE) / active ELSE 0 END AS shop_rate,
 CASE WHEN active > 0 THEN spend / active ELSE 0 END AS spend_rate,
 CASE WHEN tx > 0 THEN spend / tx ELSE 0 END AS average_ticket,
 CASE WHEN shoppers > 0 THEN CAST(tx AS DOUBLE) / shoppers ELSE 0 END AS avg_transactions_per_shopper,
 CASE WHEN base_active > 0 THEN CAST(base_shoppers AS DOUBLE) / base_active ELSE 0 END
 AS baseline_shop_rate,
 CASE WHEN base_active > 0 THEN base_spend / base_active ELSE 0 END AS baseline_spend_rate,
 CASE WHEN base_active > 0 AND base_shoppers > 0 AND active > 0
  THEN (CAST(shoppers AS DOUBLE) / active) / (CAST(base_shoppers AS DOUBLE) / base_active) END
 AS shop_rate_lift,
 CASE WHEN base_active > 0 AND base_spend > 0 AND active > 0
  THEN (spend / active) / (base_spend / base_active) END AS spend_rate_lift"""
RATE_COLUMNS = ("shop_rate", "spend_rate", "average_ticket", "avg_transactions_per_shopper",
                "baseline_shop_rate", "baseline_spend_rate", "shop_rate_lift", "spend_rate_lift")


def _validated(members: str, out: str, by_seed: bool = False) -> str:
    """CTEs computing the validation of ``members(audience_id, individual_id[, is_seed])``."""
    key = "audience_id, is_seed" if by_seed else "audience_id"
    hay = "upper(concat_ws(chr(1), brand_name, store_name, merchant_description))"
    left = "JOIN" if by_seed else "LEFT JOIN"
    return f"""hits_{out} AS (SELECT c.audience_id, f.individual_id, f.txid, f.trans_amount,
 regexp_matches({hay}, upper(replace(c.keywords, ',', '|'))) AS hit
 FROM fact f JOIN config c ON f.trans_date >= c.date_start AND f.trans_date < c.date_end),
base_{out} AS (SELECT audience_id, count(DISTINCT individual_id) AS base_active,
 count(DISTINCT CASE WHEN hit THEN individual_id END) AS base_shoppers,
 COALESCE(CAST(sum(CASE WHEN hit THEN trans_amount END) AS DOUBLE), 0) AS base_spend
 FROM hits_{out} GROUP BY audience_id),
sizes_{out} AS (SELECT {key}, count(DISTINCT individual_id) AS total FROM {members} GROUP BY {key}),
met_{out} AS (SELECT {key}, count(DISTINCT h.individual_id) AS active,
 count(DISTINCT CASE WHEN hit THEN h.individual_id END) AS shoppers,
 count(CASE WHEN hit THEN txid END) AS tx,
 CAST(sum(CASE WHEN hit THEN trans_amount END) AS DOUBLE) AS spend
 FROM {members} JOIN hits_{out} h USING (audience_id, individual_id) GROUP BY {key}),
rows_{out} AS (SELECT c.name AS audience_name, c.audience_id{', s.is_seed' if by_seed else ''},
 COALESCE(total, 0) AS total_lal_ids, COALESCE(active, 0) AS active,
 COALESCE(shoppers, 0) AS shoppers, COALESCE(tx, 0) AS tx, COALESCE(spend, 0) AS spend,
 COALESCE(base_active, 0) AS base_active, COALESCE(base_shoppers, 0) AS base_shoppers,
 COALESCE(base_spend, 0) AS base_spend FROM config c
 {left} sizes_{out} s ON s.audience_id = c.audience_id
 LEFT JOIN met_{out} m ON m.audience_id = c.audience_id
 {'AND m.is_seed = s.is_seed' if by_seed else ''}
 LEFT JOIN base_{out} b ON b.audience_id = c.audience_id),
{out} AS (SELECT *, active AS active_matched_ids, shoppers AS brand_shoppers,
 tx AS brand_transactions, spend AS brand_spend, base_active AS baseline_active_ids,
 base_shoppers AS baseline_brand_shoppers, {RATES} FROM rows_{out})"""


COUNTS = ("total_lal_ids", "active_matched_ids", "brand_shoppers", "brand_transactions",
          "baseline_active_ids", "baseline_brand_shoppers")


def reach_curve() -> str:
    members = " UNION ALL ".join(f"SELECT CAST({n} AS BIGINT) AS audience_size, individual_id "
                                 f"FROM board WHERE rn <= {n}" for n in (100, 400, 1000))
    return f"""WITH {_scored()}, members AS ({members}),
held AS (SELECT individual_id, txid, trans_amount, {brand(A.KEYWORDS)} IS TRUE AS hit FROM fact
 WHERE trans_date >= DATE '{D0}' AND trans_date < DATE '{D1}'),
rows_ AS (SELECT audience_size, count(DISTINCT m.individual_id) AS total_lal_ids,
 count(DISTINCT h.individual_id) AS active,
 count(DISTINCT CASE WHEN hit THEN h.individual_id END) AS shoppers,
 count(CASE WHEN hit THEN txid END) AS tx,
 COALESCE(CAST(sum(CASE WHEN hit THEN trans_amount END) AS DOUBLE), 0) AS spend
 FROM members m LEFT JOIN held h ON h.individual_id = m.individual_id GROUP BY audience_size),
base AS (SELECT count(DISTINCT individual_id) AS base_active,
 count(DISTINCT CASE WHEN hit THEN individual_id END) AS base_shoppers,
 COALESCE(CAST(sum(CASE WHEN hit THEN trans_amount END) AS DOUBLE), 0) AS base_spend FROM held),
out AS (SELECT *, active AS active_matched_ids, shoppers AS brand_shoppers, tx AS brand_transactions,
 spend AS brand_spend, base_active AS baseline_active_ids,
 base_shoppers AS baseline_brand_shoppers, {RATES} FROM rows_ CROSS JOIN base)
SELECT audience_size, {big(*COUNTS)}, {dbl('brand_spend', *RATE_COLUMNS)} FROM out"""


def validation_many() -> str:
    words = ", ".join(f"word{i}" for i in range(1, 6))
    out = (f"SELECT audience_name, audience_id, {big(*COUNTS)}, {dbl('brand_spend', *RATE_COLUMNS)}, "
           "CAST(NULL AS VARCHAR) AS error FROM out")
    nothing = ", ".join(f"NULL AS {c}" for c in (*COUNTS, "brand_spend", *RATE_COLUMNS))
    return f"""WITH {FACT}, entries AS ({A.MANY_CONFIG}), lookup AS ({A.MANY_LOOKUP}),
config AS (SELECT audience_id, name, CAST(date_start AS DATE) AS s, CAST(date_end AS DATE) AS e, [{words}] AS words FROM entries),
sound AS (SELECT * FROM config WHERE s < e),
names AS (SELECT DISTINCT brand_name, store_name, merchant_description FROM fact),
fits AS (SELECT DISTINCT audience_id, s, e, brand_name, store_name, merchant_description
 FROM (SELECT audience_id, s, e, unnest(words) AS w FROM sound) k JOIN names
 ON contains(upper(concat_ws(chr(1), brand_name, store_name, merchant_description)), upper(w))),
hits AS (SELECT audience_id, individual_id, txid, trans_amount FROM fact f JOIN fits h
 ON f.brand_name IS NOT DISTINCT FROM h.brand_name AND f.store_name IS NOT DISTINCT FROM h.store_name
 AND f.merchant_description IS NOT DISTINCT FROM h.merchant_description AND trans_date >= s AND trans_date < e),
spans AS (SELECT DISTINCT s, e FROM sound),
seen AS (SELECT DISTINCT s, e, individual_id FROM fact JOIN spans ON trans_date >= s AND trans_date < e
 WHERE individual_id IS NOT NULL),
base_all AS (SELECT s, e, count(*) AS base_active FROM seen GROUP BY s, e),
base AS (SELECT audience_id, count(DISTINCT individual_id) AS base_shoppers, CAST(sum(trans_amount) AS DOUBLE) AS base_spend
 FROM hits GROUP BY audience_id),
bought AS (SELECT audience_id, individual_id, count(txid) AS tx, sum(trans_amount) AS spend FROM hits
 WHERE individual_id IS NOT NULL GROUP BY ALL),
met AS (SELECT c.audience_id, count(*) AS total, count(v.individual_id) AS active, count(b.individual_id) AS shoppers,
 COALESCE(sum(b.tx), 0) AS tx, COALESCE(CAST(sum(b.spend) AS DOUBLE), 0) AS spend
 FROM sound c JOIN (SELECT DISTINCT audience_id, individual_id FROM lookup) l ON l.audience_id = c.audience_id
 LEFT JOIN seen v ON v.s = c.s AND v.e = c.e AND v.individual_id = l.individual_id
 LEFT JOIN bought b ON b.audience_id = c.audience_id AND b.individual_id = l.individual_id GROUP BY c.audience_id),
rows_ AS (SELECT c.name AS audience_name, c.audience_id, COALESCE(total, 0) AS total_lal_ids, COALESCE(active, 0) AS active,
 COALESCE(shoppers, 0) AS shoppers, COALESCE(tx, 0) AS tx, COALESCE(spend, 0) AS spend,
 COALESCE(base_active, 0) AS base_active, COALESCE(base_shoppers, 0) AS base_shoppers, COALESCE(base_spend, 0) AS base_spend
 FROM sound c LEFT JOIN met USING (audience_id) LEFT JOIN base_all a ON a.s = c.s AND a.e = c.e
 LEFT JOIN base USING (audience_id)),
out AS (SELECT *, active AS active_matched_ids, shoppers AS brand_shoppers, tx AS brand_transactions,
 spend AS brand_spend, base_active AS baseline_active_ids, base_shoppers AS baseline_brand_shoppers, {RATES} FROM rows_)
{out} UNION ALL BY NAME SELECT name AS audience_name, audience_id, {nothing}, 'the window is empty' AS error
FROM config WHERE NOT s < e"""


def run_delta() -> str:
    metrics = ("total_lal_ids", "active_matched_ids", "brand_shoppers", "brand_spend", "shop_rate")

    def long(name, value):
        return " UNION ALL ".join(f"SELECT audience_id, '{m}' AS metric, CAST({m} AS DOUBLE) AS "
                                  f"{value} FROM {name}" for m in metrics)
    return f"""WITH {FACT}, {CONFIG}, {LATEST},
first_ AS (SELECT * FROM lookup WHERE ver = 1),
{_validated('first_', 'old')}, {_validated('latest', 'new')},
o AS ({long('old', 'previous')}), n AS ({long('new', '"current"')})
SELECT audience_id, metric, {dbl('previous')}, ROUND("current", 6) AS "current",
 ROUND("current" - previous, 6) AS change,
 ROUND(("current" - previous) / NULLIF(previous, 0) * 100, 6) AS change_pct
FROM o FULL JOIN n USING (audience_id, metric)"""


def cohorts(op: str) -> str:
    a = seed(months=3, minimum=1, ref="DATE '2001-07-31'")
    b = seed(months=3, minimum=1, ref="DATE '2001-04-30'")
    return f"WITH {FACT}, a AS ({a}), b AS ({b}) SELECT * FROM a {op} SELECT * FROM b"


# --- rollups -----------------------------------------------------------------------------------
def _pairs(fields):
    return [(out, tag) for out, _, tag in fields if tag]


def _age(index: int, strict: bool) -> str:
    table = dict(codes.AGE_CODES)
    if not strict:
        table["18-24"] = (1, 1)
    whens = " ".join(f"WHEN age_bucket = '{k}' THEN {v[index]}" for k, v in table.items())
    senior = codes.SENIOR_DETAILED if index else codes.SENIOR_COARSE
    older = " ".join(f"WHEN age >= {lo}" + (f" AND age <= {hi}" if hi else "") + f" THEN {v}"
                     for lo, hi, v in senior)
    return f"CASE {whens} WHEN age_bucket = '60+' THEN CASE {older} ELSE {senior[0][2]} END ELSE 0 END"


def _investment() -> str:
    values = [f"COALESCE(TRY_CAST({c} AS INT), 100)" for c, _ in codes.INVESTMENT_LABELS]
    low = f"least({', '.join(values)})"
    whens = " ".join(f"WHEN {v} = {low} THEN '{label}'"
                     for v, (_, label) in zip(values, codes.INVESTMENT_LABELS))
    return f"CASE WHEN {low} >= 50 THEN 'Unknown' {whens} END"


PERSON = {
    "household_id": "household_id", "weight": "CAST(1 AS BIGINT)",
    "gender": case("gender", codes.GENDER_LETTER, "UNDETERMINED"),
    "zip_code": "zip_code", "age": "CAST(age AS BIGINT)",
    "age_bucket": f"CAST({_age(0, False)} AS BIGINT)",
    "age_bucket_detailed": f"CAST({_age(1, False)} AS BIGINT)",
    "ethnicity_prediction": "ethnicity",
    "education": case("education_level", codes.EDUCATION_CLASS, "Unknown"),
    "marital_status": "marital_status", "state": "state", "occupation": "occupation",
    **{n: "CAST(0 AS BIGINT)" for n in ("emails", "maids", "phones", "ips")},
    "general_interests": present_map(_pairs(codes.GENERAL_INTERESTS)),
    "sports_interests": present_map(_pairs(codes.SPORTS_INTERESTS)),
    "reading_interests": present_map(_pairs(codes.READING_INTERESTS)),
    "travel_interests": flag_map([(c, t, 99) for c, t in _pairs(codes.TRAVEL_INTERESTS)]),
    "financial_health_bucket": "CAST(CASE financial_health_bucket WHEN 'LOW' THEN 1 WHEN 'MEDIUM' "
                               "THEN 2 WHEN 'HIGH' THEN 3 WHEN 'EXCELLENT' THEN 4 END AS BIGINT)",
    "net_worth_bucket": case("net_worth_bucket", codes.NET_WORTH_LETTER, "Unknown"),
    "credit_card_info": flag_map([(c, t, s) for c, _, t, s in codes.CREDIT_CARDS]),
    "investment_type": _investment(), "partition_date": "CAST(partition_date AS VARCHAR)",
}


def person(*cols: str, strict: bool = False) -> str:
    fields = dict(PERSON)
    if strict:
        fields["age_bucket"] = f"CAST({_age(0, True)} AS BIGINT)"
        fields["age_bucket_detailed"] = f"CAST({_age(1, True)} AS BIGINT)"
    items = ", ".join(f"{fields[c]} AS {c}" for c in (cols or fields))
    return f"WITH {ATTRS} SELECT individual_id, {items} FROM attrs"


def _income(unit: int) -> str:
    whens = []
    for label, (limit, below, above) in codes.INCOME_CODES.items():
        if limit:
            whens.append(f"WHEN income_bucket = '{label}' AND household_income_k < {limit * unit} "
                         f"THEN {below}")
        whens.append(f"WHEN income_bucket = '{label}' THEN {above}")
    return f"CASE {' '.join(whens)} ELSE {codes.INCOME_CODE_UNKNOWN} END"


def household(*cols: str, strict: bool = False) -> str:
    children = joined([f"CASE WHEN child_age_group LIKE '%{label}%' THEN '{label}=1' END"
                       for _, label in codes.CHILD_AGE_FIELDS])
    fields = {
        "partition_date": "CAST(partition_date AS VARCHAR)", "household_id": "household_id",
        "income": "CAST(household_income_k AS BIGINT)",
        "income_bucket": f"CAST({_income(1 if strict else 1000)} AS BIGINT)",
        "child_age_group": f"CASE WHEN child_age_group <> '' THEN {children} END",
        "homeowner": "CAST(CASE WHEN homeowner_status = 'HOMEOWNER' THEN 1 ELSE 0 END AS BIGINT)",
        "number_of_children": "CAST(number_of_children AS BIGINT)",
        "presence_of_children": "CAST(CASE WHEN presence_of_children = 1 THEN 1 ELSE 0 END AS BIGINT)",
        "num_people_in_household": "CAST(num_people_in_household_group AS BIGINT)",
        "num_people_in_household_group": "CAST(num_people_in_household_group AS BIGINT)",
        "median_home_value_by_state": "state || '=' || CAST(median_home_value_by_state AS VARCHAR)",
        "hh_weight": "CAST(1 AS BIGINT)"}
    names = ("household_id", *cols) if cols else tuple(fields)
    return f"WITH {ATTRS} SELECT " + ", ".join(f"{fields[c]} AS {c}" for c in names) + " FROM attrs"


def _media() -> str:
    return "media AS (" + " UNION ALL ".join(
        f"SELECT individual_id, partition_date, '{kind}' AS attr_type, '{tag}' AS attr_value FROM attrs "
        f"WHERE {c} IS NOT NULL AND {c} <> ''"
        for kind, pairs in codes.MEDIA_TAGS.items() for c, tag in pairs) + ")"


def media_rollup() -> str:
    maps = ", ".join(
        f"COALESCE(string_agg(attr_value || '=' || n, ',' ORDER BY attr_value || '=' || n) "
        f"FILTER (WHERE attr_type = '{kind}'), '') AS {codes.MEDIA_COLUMNS[kind]}"
        for kind in codes.MEDIA_TYPES)
    return f"""WITH {ATTRS}, {_media()}, counted AS (SELECT individual_id, partition_date, attr_type,
 attr_value, count(*) AS n FROM media GROUP BY ALL)
SELECT individual_id, {text('partition_date')}, {maps}, CAST(1 AS BIGINT) AS media_weight
FROM counted GROUP BY individual_id, partition_date"""


def tag_list(kind: str) -> str:
    items = ", ".join(f"CASE WHEN {c} <> '' THEN '{t}' END" for c, t in codes.MEDIA_TAGS[kind])
    return f"concat_ws('|', {items})"


BAD_BALANCE, BAD_DATE = "c_custkey % 7 = 2", "c_custkey % 11 = 3"
TREND = "CAST(tot_trans_3mo AS DOUBLE) / NULLIF(tot_trans_12mo, 0)"

ORACLES: dict[str, str] = {
    "scan_parquet_by_name": 'SELECT CAST(c_custkey AS VARCHAR) AS "C_CUSTKEY", c_name AS "C_NAME", '
                            'c_mktsegment AS "c_MktSegment", CAST(NULL AS VARCHAR) AS not_delivered '
                            "FROM customer",
    "load_rejects": "SELECT CAST(c_custkey AS VARCHAR) AS custkey, c_mktsegment AS segment "
                    f"FROM customer WHERE {BAD_BALANCE} OR {BAD_DATE}",
    "load_good": "SELECT c_custkey AS custkey, c_mktsegment AS segment, '2001-01-05' AS opened, "
                 "ROUND(c_acctbal, 6) AS balance FROM customer "
                 f"WHERE NOT ({BAD_BALANCE} OR {BAD_DATE})",
    "load_report": "SELECT count(*) AS row_parsed, count(*) FILTER (WHERE NOT "
                   f"({BAD_BALANCE} OR {BAD_DATE})) AS row_count, count(*) FILTER (WHERE "
                   f"{BAD_BALANCE} OR {BAD_DATE}) AS error_count, CAST(1 AS BIGINT) AS has_error "
                   "FROM customer",
    "row_counts": " UNION ALL ".join(f"SELECT '{t.upper()}' AS table_name, count(*) AS row_count "
                                     f"FROM {t}" for t in [*A.TABLES, *A.TEXT_TABLES]),
    "audience_config": f"WITH {CONFIG} SELECT audience_id, name, replace(keywords, ',', '|') AS "
                       f"brand_keywords, {text('date_start', 'date_end')} FROM config",
    "enrich": fact_row(), "enrich_salted": fact_row(),
    "enrich_batch": fact_row("trans_date BETWEEN DATE '2001-01-01' AND DATE '2001-01-31'"),
    "experiment_group": attr_row("experiment_group"),
    "daily_summary": daily_summary(), "daily_summary_spread": daily_summary(),
    "daily_mode": f"WITH {FACT}, {_mode('trans_time_zone')}, {_mode('brand_name')} SELECT "
                  f"{text('trans_date')}, individual_id, transaction_count, trans_time_zone, "
                  "brand_name AS top_brand FROM (SELECT trans_date, individual_id, count(*) AS "
                  "transaction_count FROM known GROUP BY ALL) "
                  "LEFT JOIN mode_trans_time_zone USING (trans_date, individual_id) "
                  "LEFT JOIN mode_brand_name USING (trans_date, individual_id)",
    "distinct_lists": f"WITH {FACT} SELECT {text('trans_date')}, individual_id, "
                      f"{_list('brand_name')} AS brand_list, {_list('store_id')} AS store_list, "
                      "count(DISTINCT mtid) AS terminals FROM known GROUP BY trans_date, individual_id",
    "distinct_rows": f"WITH {FACT} SELECT DISTINCT {text('trans_date')}, brand_name, merchant_state, "
                     "transaction_channel FROM fact",
    "incremental_slice": f"WITH {FACT} SELECT txid, {text('trans_date')}, {dbl('trans_amount')} FROM "
                         "fact WHERE trans_date > (SELECT max(trans_date) - INTERVAL 3 DAY FROM fact "
                         "WHERE trans_date <= DATE '2001-03-31')",
    "merge_upsert": f"WITH {FACT} SELECT {text('trans_date')}, individual_id, count(*) + CASE WHEN "
                    "trans_date <= DATE '2001-02-28' THEN 1000 ELSE 0 END AS transaction_count, "
                    "ROUND(CAST(sum(trans_amount) AS DOUBLE), 6) AS total_transaction_amount "
                    "FROM known GROUP BY trans_date, individual_id",
    "holdout_filter": f"WITH {FACT} SELECT txid, individual_id, {text('trans_date')}, "
                      f"{dbl('trans_amount')} FROM fact WHERE trans_date >= DATE '{D0}' AND "
                      f"trans_date < DATE '{D1}'",
    "brand_filter": f"WITH {FACT} SELECT txid, {', '.join(NAMES)} FROM fact WHERE "
                    f"{brand(['Ring', 'brand#1', 'GIZMO 4'])}",
    "ref_date": f"WITH {FACT} SELECT CAST(d AS VARCHAR) AS ref_date FROM ref",
    "normalise_values": f"WITH {FACT} SELECT txid, replace(lower(merchant_description), ' ', '-') AS "
                        "merchant, upper(store_state) AS state, CAST((store_name IS NOT NULL)::INT + "
                        "(brand_name IS NOT NULL)::INT AS BIGINT) AS parts FROM fact",
    "attributes": attr_row(),
    "decode_codes": attr_row(*[n for n, *_ in codes.DECODED_FIELDS], "occupation_model"),
    "parse_age": attr_row("age"), "age_bucket": attr_row("age_bucket"),
    "income_amount": attr_row("household_income_k"),
    "hh_counts": attr_row("adults_in_hh", "number_of_children", "num_people_in_household_group",
                          "median_home_value_by_state"),
    "partition_date": attr_row("partition_date"),
    "child_age_group": attr_row("child_age_group", "presence_of_children"),
    "person_rollup": person(), "person_rollup_strict": person(strict=True),
    "age_code": person("age_bucket", "age_bucket_detailed"),
    "interest_map": person("general_interests", "sports_interests", "reading_interests"),
    "flag_map": person("travel_interests", "credit_card_info"),
    "argmin_label": person("investment_type"),
    "propensity_flags": f"WITH {ATTRS} SELECT individual_id, " + ", ".join(
        f"CAST({likely(c, s)} AS BIGINT) AS {t.lower()}" for c, _, t, s in codes.CREDIT_CARDS)
        + " FROM attrs",
    "household_rollup": household(), "household_rollup_strict": household(strict=True),
    "income_code": household("income", "income_bucket"),
    "hh_flags": household("homeowner", "presence_of_children"),
    "child_age_map": household("child_age_group"),
    "dynamic_map": household("median_home_value_by_state"),
    "media_tags": f"WITH {ATTRS}, {_media()} SELECT attr_type, attr_value, count(*) AS people "
                  "FROM media GROUP BY ALL",
    "media_long": f"WITH {ATTRS}, {_media()} SELECT individual_id, {text('partition_date')}, "
                  "attr_type, attr_value FROM media",
    "tag_array": f"WITH {ATTRS} SELECT individual_id, {tag_list('networks')} AS networks, "
                 f"{tag_list('titles')} AS titles FROM attrs",
    "media_rollup": media_rollup(), "media_rollup_unique": media_rollup(),
    "rfm_features": rfm_row(), "rfm_pinned": rfm_row("DATE '2001-06-30'"),
    "brand_diversity": f"WITH {FACT}, {_rfm()} SELECT individual_id, "
                       + ", ".join(f"brand_diversity_{m}mo" for m in codes.RFM_WINDOWS) + " FROM rfm",
    "rfm_segments": f"WITH {FACT}, {_rfm()} SELECT individual_id, ROUND({TREND}, 6) AS trend_ratio, "
                    f"COALESCE({TREND} > 0.4, FALSE) AS is_accelerating, CASE WHEN "
                    "avg_days_btwn_trans_12mo < 7 THEN 'weekly' WHEN avg_days_btwn_trans_12mo < 30 "
                    "THEN 'monthly' WHEN avg_days_btwn_trans_12mo > 60 THEN 'infrequent' END AS "
                    "cadence, "
                    "ROUND(CAST(tot_online_trans_12mo AS DOUBLE) / NULLIF(tot_trans_12mo, 0), 6) "
                    "AS online_ratio FROM rfm",
    "seed_ids": f"WITH {FACT} {seed()}",
    "seed_retail": f"WITH {FACT} {seed(minimum=3, extra='month(trans_date) NOT IN (11, 12)')}",
    "seed_holiday": f"WITH {FACT} {seed(['RING', 'WIDGET'], extra=HOLIDAY)}",
    "month_filters": f"WITH {FACT} SELECT year(trans_date) AS year, count(*) AS transactions, "
                     "count(DISTINCT individual_id) AS people FROM known WHERE "
                     f"{HOLIDAY} GROUP BY ALL",
    "seed_recency": f"WITH {FACT}, {_rfm()}, s AS ({seed()}) SELECT individual_id FROM s JOIN rfm "
                    "USING (individual_id) WHERE days_since_last_txn < 60",
    "seed_online": f"WITH {FACT} {seed(minimum=1, extra=ONLINE)}",
    "seed_grid": seed_grid(),
    "pop_features": pop_row("attrs"), "pop_features_rfm": pop_row("rfm"),
    "numeric_profile": f"WITH {_pop()}, {_profile()} SELECT (SELECT count(*) FROM pop WHERE is_seed = "
                       f"1) AS n_seeds, (SELECT count(*) FROM pop) AS n_population, feature, {dbl('seed_mean', 'seed_std', 'pop_mean', 'pop_std')}"
                       " FROM profile",
    "category_shares": f"WITH {_pop()}, {_shares()} SELECT field, value, {big('seed_count')}, "
                       f"pop_count, {dbl('seed_share', 'pop_share')} FROM shares",
    "categorical_importance": f"WITH {_pop()}, {_shares()} SELECT field, {dbl('importance')} "
                              "FROM importance",
    "lookalike_scores": f"WITH {_scored()} SELECT individual_id, {big('is_seed')}, "
                        + dbl("numeric_similarity_score", "categorical_similarity_score",
                              "similarity_score") + " FROM scored",
    "top_n_audience": TOP_N, "top_n_ranges": TOP_N, "lookalike_scores_n": RANKED + "500",
    "lookalike_scores_half": RANKED + "(SELECT count(*) // 2 FROM pop)",
    "latest_version": f"WITH {LATEST} SELECT individual_id, audience_id, {big('ver')} FROM latest",
    "audience_validation": f"WITH {FACT}, {CONFIG}, {LATEST}, {_validated('latest', 'result')} SELECT "
                           f"audience_name, audience_id, {big(*COUNTS)}, "
                           f"{dbl('brand_spend', *RATE_COLUMNS)}, CAST(NULL AS VARCHAR) AS error FROM result",
    "validation_many": validation_many(),
    "validation_by_seed": f"WITH {FACT}, {CONFIG}, {LATEST}, flagged AS (SELECT l.audience_id, "
                          "l.individual_id, CASE WHEN s.individual_id IS NULL THEN 0 ELSE 1 END AS "
                          f"is_seed FROM latest l LEFT JOIN ({seed(minimum=1)}) s ON s.individual_id "
                          f"= l.individual_id), {_validated('flagged', 'result', True)} SELECT "
                          f"audience_name, audience_id, {big('is_seed', *COUNTS)}, "
                          f"{dbl('brand_spend', *RATE_COLUMNS)}, CAST(NULL AS VARCHAR) AS error FROM result",
    "reach_curve": reach_curve(), "run_delta": run_delta(),
    "semi_active": f"WITH {FACT} SELECT CAST(c_custkey AS VARCHAR) AS individual_id FROM customer "
                   "WHERE CAST(c_custkey AS VARCHAR) IN (SELECT individual_id FROM known WHERE "
                   f"trans_date >= DATE '{D0}' AND trans_date < DATE '{D1}')",
    "count_ids": f"WITH {FACT} SELECT count(DISTINCT individual_id) AS online_people FROM fact WHERE "
                 f"{ONLINE} AND trans_date >= DATE '{D0}' AND trans_date < DATE '{D1}'",
    "cohort_union": cohorts("UNION"), "cohort_intersect": cohorts("INTERSECT"),
    "cohort_except": cohorts("EXCEPT"),
    "dq_unique": f"WITH {FACT} SELECT txid, count(*) AS n FROM fact GROUP BY txid HAVING count(*) > 1",
    "dq_not_null": f"WITH {FACT} SELECT txid, membccid FROM fact WHERE individual_id IS NULL",
    "dq_unique_combo": f"WITH {FACT} SELECT {text('trans_date')}, membccid, count(*) AS n FROM fact "
                       "GROUP BY trans_date, membccid HAVING count(*) > 1",
    "dq_expression": f"WITH {FACT} SELECT txid, {dbl('trans_amount')} FROM fact WHERE NOT "
                     "COALESCE(trans_amount >= 5000, FALSE)",
}


def _dq_report() -> str:
    def row(rule, target, failures, nulls):
        return f"SELECT '{rule}' AS rule, '{target}' AS target, {failures} AS failures, {nulls} AS nulls"
    rows = []
    for c in ("txid", "trans_date", "trans_amount", "individual_id", "mtid"):
        n = f"(SELECT count(*) FROM fact WHERE {c} IS NULL)"
        rows.append(row("not_null", c, n, n))
    for e in ("trans_amount >= 0", "brand_id <= 20", "length(mtid) < 4"):
        rows.append(row("expr", e, f"(SELECT count(*) FROM fact WHERE NOT ({e}))",
                        f"(SELECT count(*) FROM fact WHERE ({e}) IS NULL)"))
    rows.append(row("unique", "txid", "(SELECT count(*) FROM (SELECT txid FROM fact GROUP BY txid "
                    "HAVING count(*) > 1))", "CAST(0 AS BIGINT)"))
    rows.append(row("unique_combo", "trans_date,individual_id", "(SELECT count(*) FROM (SELECT 1 FROM "
                    "fact GROUP BY trans_date, individual_id HAVING count(*) > 1))",
                    "CAST(0 AS BIGINT)"))
    return f"WITH {FACT} " + " UNION ALL ".join(rows)


ORACLES["build_incremental"] = ORACLES["build_range"] = ORACLES["daily_summary"]
ORACLES["dq_report"] = _dq_report()
ORACLES["stream_ingest"] = \
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, " \
    f"{dbl('value')}, props FROM events"
ORACLES["stream_daily"] = (
    "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, user_id, count(*) AS transaction_count, "
    "ROUND(sum(value), 6) AS total_amount, ROUND(min(value), 6) AS min_amount, "
    "ROUND(max(value), 6) AS max_amount FROM events GROUP BY CAST(ts AS DATE), user_id")
ORACLES["stream_upsert"] = (
    "SELECT user_id, arg_max(event_id, ts) AS event_id, arg_max(event_type, ts) AS event_type, "
    "CAST(user_id % 4 AS BIGINT) AS shard FROM events GROUP BY user_id")
ORACLES["stream_enrich"] = (
    f"WITH card AS ({A.select_sql('card')}) SELECT e.event_id, e.user_id, ROUND(e.value, 6) AS "
    "value, c.card_type, c.individual_id FROM events e LEFT JOIN card c "
    "ON CAST(c.membccid AS BIGINT) = e.user_id")

_SOUND = f"NOT ({BAD_BALANCE} OR {BAD_DATE})"
_SEGMENTS = ("SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS place, "
             f"{_SOUND} AS sound FROM customer")
_FILE_COUNTS = ("c_mktsegment AS segment, count(*) AS row_parsed, count(*) FILTER (WHERE sound) AS row_count, "
                "count(*) FILTER (WHERE NOT sound) AS error_count, CASE WHEN bool_and(sound) THEN 'LOADED' "
                "WHEN bool_or(sound) THEN 'PARTIALLY_LOADED' ELSE 'LOAD_FAILED' END AS status, "
                "CAST(min(c_custkey) FILTER (WHERE NOT sound) AS VARCHAR) AS first_custkey")
_LOADED = "c_custkey AS custkey, '2001-01-05' AS opened, ROUND(c_acctbal, 6) AS balance"
ORACLES["load_report_files"] = (
    f"SELECT {_FILE_COUNTS}, 1 + min(place) FILTER (WHERE NOT sound) AS first_error_line FROM ({_SEGMENTS}) GROUP BY ALL")
ORACLES["stream_load_history"] = f"SELECT {_FILE_COUNTS} FROM ({_SEGMENTS}) GROUP BY ALL"
ORACLES["list_segments"] = ("SELECT DISTINCT c_mktsegment AS segment, TRUE AS filled FROM customer "
                            "WHERE regexp_matches(c_mktsegment, '^[A-M]')")
ORACLES["load_stamped"] = f"SELECT {_LOADED}, TRUE AS stamped FROM customer WHERE {_SOUND}"
ORACLES["stream_load_good"] = f"SELECT {_LOADED} FROM customer WHERE {_SOUND}"
ORACLES["stream_load_rejects"] = ("SELECT c_mktsegment AS segment, CAST(c_custkey AS VARCHAR) AS custkey FROM customer "
                                  f"WHERE NOT ({_SOUND})")
ORACLES["load_columns"] = (
    f"WITH tx AS ({A.select_sql('tx')}) SELECT txid, mtid, membccid, CAST(trans_date AS VARCHAR) AS trans_date, trans_time, "
    "trans_time_zone, ROUND(CAST(trans_amount AS DOUBLE), 6) AS trans_amount, CAST(delivery_date AS VARCHAR) AS delivery_date FROM tx")
ORACLES["csv_export"] = ("SELECT c_custkey AS custkey, c_name || ', \"' || c_mktsegment || '\"' AS label, "
                         "CAST(c_acctbal AS VARCHAR) AS balance FROM customer")
ORACLES["saved_audience"] = f"WITH {_scored()} SELECT individual_id, {big('is_seed')}, similarity_score FROM board"
ORACLES["clustered_fact"] = ORACLES["interleaved_fact"] = ORACLES["enrich"]
ORACLES["merged_drop"] = ('SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS "C_Name", '
                          "CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS c_mktsegment FROM customer")
ORACLES["seed_cause"] = f"WITH {FACT} {seed()}"
ORACLES["seed_gaming"] = f"WITH {FACT} {seed(months=6)}"
ORACLES["stream_daily_summary"] = ORACLES["daily_summary"]
ORACLES["stream_upsert_late"] = ORACLES["stream_upsert"]


def _dq_products() -> str:
    rows = {"fact": "enrich", "daily_summary": "daily_summary", "rfm_features": "rfm_features", "attributes": "attributes",
            "person_rollup": "person_rollup", "household_rollup": "household_rollup", "media_rollup": "media_rollup"}
    tables = ", ".join(f"p_{product} AS MATERIALIZED ({ORACLES[query]})" for product, query in rows.items())
    counts = []
    for product, rules in RULES.items():
        for kind, arg in rules:
            target = arg if isinstance(arg, str) else ",".join(arg)
            table, nulls = f"p_{product}", "CAST(0 AS BIGINT)"
            if kind == "not_null":
                failed = nulls = f"(SELECT count(*) FROM {table} WHERE {arg} IS NULL)"
            elif kind == "expr":
                failed = f"(SELECT count(*) FROM {table} WHERE NOT ({arg}))"
                nulls = f"(SELECT count(*) FROM {table} WHERE ({arg}) IS NULL)"
            else:
                known = f"WHERE {arg} IS NOT NULL" if kind == "unique" else ""
                failed = f"(SELECT count(*) FROM (SELECT {target} FROM {table} {known} GROUP BY ALL HAVING count(*) > 1))"
            counts.append(f"SELECT '{product}' AS product, '{kind}' AS rule, '{target}' AS target, {failed} AS failures, {nulls} AS nulls")
    return f"WITH {tables} " + " UNION ALL ".join(counts)


ORACLES["dq_products"] = _dq_products()
ORACLES["documented_table"] = "SELECT * FROM (VALUES " + ", ".join(
    "('{}', '{}')".format(c, comment_of(c).replace("'", "''")) for c in ATTR_COLUMNS) + ") t(col_name, comment)"

ORACLES["row_counts_footers"] = ORACLES["row_counts"]
ORACLES["key_extremes"] = ("SELECT count(*) AS row_count, min(o_orderkey) AS o_orderkey_min, max(o_orderkey) AS o_orderkey_max, "
                           "min(o_custkey) AS o_custkey_min, max(o_custkey) AS o_custkey_max FROM orders")
ORACLES["cohort_overlap"] = f"""WITH {FACT}, lookup AS ({A.LOOKUP}),
members AS (SELECT DISTINCT individual_id, audience_id || ' ' || CAST(ver AS VARCHAR) AS cohort FROM lookup
 UNION SELECT individual_id, 'summer' FROM ({seed(months=3, minimum=1, ref="DATE '2001-07-31'")})
 UNION SELECT individual_id, 'spring' FROM ({seed(months=3, minimum=1, ref="DATE '2001-04-30'")})),
sizes AS (SELECT cohort, count(*) AS n FROM members GROUP BY cohort)
SELECT a.cohort, b.cohort AS other, a.n AS ids, b.n AS other_ids, count(y.individual_id) AS both,
 ROUND(CAST(count(y.individual_id) AS DOUBLE) / least(a.n, b.n), 6) AS share
FROM sizes a JOIN sizes b ON a.cohort < b.cohort JOIN members x ON x.cohort = a.cohort
LEFT JOIN members y ON y.cohort = b.cohort AND y.individual_id = x.individual_id GROUP BY a.cohort, b.cohort, a.n, b.n"""


def _tuned(name: str, low: int, high: int) -> str:
    """The walk of settings as one ordered list, and the step it ends on."""
    return f"""(SELECT '{name}' AS target, lookback_months, min_transactions, max_recency, seed_size,
 seed_size BETWEEN {low} AND {high} AS in_target FROM way, (SELECT COALESCE(min(step) FILTER (seed_size <= {high}), max(step)) AS stop,
 max(step) AS last FROM way) s WHERE step = greatest(1, stop - CASE WHEN (SELECT seed_size FROM way WHERE step = stop) < {low}
 THEN 1 ELSE 0 END))"""


ORACLES["tuned_seed"] = (
    f"WITH grid AS ({seed_grid()}), way AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN max_recency IS NULL THEN 1 ELSE 2 END, "
    "lookback_months DESC, min_transactions) AS step FROM grid WHERE (max_recency IS NULL AND lookback_months = 12) "
    "OR (max_recency IS NOT NULL AND min_transactions = 3)) "
    + " UNION ALL ".join(_tuned(*t) for t in (("hit", 20, 60), ("too_many", 0, 1), ("too_few", 10**8, 10**9))))
