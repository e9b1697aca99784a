"""The same queries as plain SQL for DuckDB, written from the source rules.

Each text states the rule directly (outer joins, ranked windows, long CASEs)
rather than the shape the DataFrame code gives it.
"""

from __future__ import annotations

from shopfloor.catalog import adapters as A
from shopfloor.functions.phone import PREFIXES

ORACLE: dict[str, str] = {}

# --- sales ----------------------------------------------------------------------

_SOLD = f"""
    FROM {A.LINES.sql()} l
    LEFT JOIN {A.HEADERS.sql()} t ON l.transaction_id = t.transaction_id
    LEFT JOIN {A.INVENTORY_ITEMS.sql()} i ON l.item_id = i.item_id
    LEFT JOIN {A.SERVICE_ITEMS.sql()} s ON s.item_id = l.item_id
    WHERE l.account_id IN (1, 2, 3, 4, 5)
      AND t.transaction_type IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
      AND t.status <> 'P'
      AND (i.displayname IS NOT NULL OR s.item_id IN (12, 16))
"""


def _total(measure: str) -> str:
    return f"CAST(-SUM(l.{measure}) AS DOUBLE)"


ORACLE["sales_order"] = f"""
    SELECT CAST(t.trandate AS DATE) AS trandate, t.tranid, t.customer_phone, l.location_id,
           {_total('item_count')} AS item_count, {_total('net_amount')} AS net_amount
    {_SOLD}
    GROUP BY t.trandate, t.create_date, t.tranid, l.location_id, t.customer_phone
"""
ORACLE["daily_sales"] = f"""
    SELECT CAST(t.trandate AS DATE) AS trandate, {_total('net_amount')} AS sales
    {_SOLD} GROUP BY t.trandate ORDER BY 1
"""
ORACLE["daily_sales_orders"] = f"""
    SELECT CAST(t.trandate AS DATE) AS trandate, {_total('net_amount')} AS sales,
           COUNT(DISTINCT t.tranid) AS orders
    {_SOLD} AND t.trandate >= DATE '2001-08-02' - 30
    GROUP BY t.trandate ORDER BY 1
"""
ORACLE["sales_order_bucketed"] = ORACLE["sales_order"]
ORACLE["conform_schema"] = f"""
    SELECT trandate AS "TRANDATE", tranid AS "TRANID", customer_phone AS "CUSTOMER_PHONE",
           CAST(location_id AS DOUBLE) AS "LOCATION_ID", item_count AS "ITEM_COUNT",
           net_amount AS "NET_AMOUNT"
    FROM ({ORACLE['sales_order']})
"""

# --- inventory ------------------------------------------------------------------

_MOVEMENT = f"""
    SELECT CAST(t.create_date + INTERVAL 7 HOURS AS DATE) AS create_date,
           CAST(COALESCE(l.location_id, 0) AS BIGINT) AS location_id,
           CAST(COALESCE(l.item_id, 0) AS BIGINT) AS item_id,
           SUM(COALESCE(l.item_count, 0)) AS item_count,
           SUM(COALESCE(l.net_amount, 0)) AS net_amount
    FROM {A.LINES.sql()} l
    LEFT JOIN {A.HEADERS.sql()} t ON l.transaction_id = t.transaction_id
    LEFT JOIN {A.HEADERS.sql()} p ON p.transaction_id = t.created_from_id
    LEFT JOIN {A.INVENTORY_ITEMS.sql()} i ON l.item_id = i.item_id
    WHERE l.account_id IN (3, 4, 5, 6, 7)
      AND t.create_date < DATE '2001-01-01' - 1
      AND t.transaction_type IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')
    GROUP BY 1, 2, 3
"""
ORACLE["stock_movement"] = f"""
    SELECT create_date, location_id, item_id, CAST(item_count AS DOUBLE) AS item_count,
           CAST(net_amount AS DOUBLE) AS net_amount
    FROM ({_MOVEMENT})
"""
_RUNNING = """CAST(trunc(SUM({m}) OVER (PARTITION BY location_id, item_id ORDER BY create_date
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS BIGINT) AS {m}"""
_BALANCE = ", ".join(_RUNNING.format(m=m) for m in ("item_count", "net_amount"))
_PREVIOUS = "LAG(create_date) OVER (PARTITION BY location_id, item_id ORDER BY create_date)"
_GAPS = f"""{_PREVIOUS} AS shift,
    CAST(create_date - {_PREVIOUS} AS DOUBLE) AS date_diff,
    CAST(date_trunc('month', create_date) AS DATE) AS som,
    CAST(create_date - CAST(date_trunc('month', create_date) AS DATE) AS BIGINT) AS som_date_diff"""
_KEYS = "create_date, location_id, item_id"
ORACLE["stock_balance"] = f"SELECT {_KEYS}, {_BALANCE} FROM ({_MOVEMENT})"
ORACLE["stock_gaps"] = f"SELECT {_KEYS}, {_GAPS} FROM ({_MOVEMENT})"
ORACLE["stock_snapshot"] = f"SELECT {_KEYS}, {_BALANCE}, {_GAPS} FROM ({_MOVEMENT})"
ORACLE["self_join_parent"] = f"""
    SELECT c.transaction_id, c.tranid, c.created_from_id, p.tranid AS parent_tranid,
           p.transaction_type AS parent_type, CAST(p.create_date AS DATE) AS parent_date
    FROM {A.HEADERS.sql()} c LEFT JOIN {A.HEADERS.sql()} p ON p.transaction_id = c.created_from_id
"""
ORACLE["local_day_shift"] = """
    SELECT event_id AS id, CAST(ts AS DATE) AS source_day,
           CAST(ts + INTERVAL 7 HOURS AS DATE) AS local_day
    FROM events
"""

# --- tickets --------------------------------------------------------------------

ORACLE["ticket_projection"] = f"""
    SELECT care_soft_ticket_id, ticket_no, ticket_subject, ticket_status, ticket_source,
           ticket_priority, assignee_id, requester_id, requester_name, requester_email,
           requester_phone_no, sla, campaign_name, created_at, updated_at
    FROM {A.TICKETS.sql()}
"""
ORACLE["call_log_projection"] = f"""
    SELECT call_id, care_soft_id, customer_id, ticket_id, caller, agent_id, group_id,
           CAST(call_type AS BIGINT) AS call_type, call_status, start_time, end_time,
           created_at, updated_at
    FROM {A.CALLS.sql()}
"""


def _code(field: int) -> str:
    number = "TRY_CAST(custom_filed_value AS DECIMAL(20,4))"
    return f"CAST(SUM(CASE WHEN custom_filed_id = {field} THEN {number} ELSE NULL END) AS DOUBLE)"


ORACLE["eav_pivot"] = f"""
    SELECT ticket_id, {_code(4871)} AS trang_thai_cham_soc, {_code(4893)} AS trang_thai_tiep_nhan
    FROM {A.CUSTOM_FIELDS.sql()} GROUP BY ticket_id
"""
_CARE_LABELS = f"SELECT id, kind AS lable FROM {A.LABEL_SOURCE.sql()} WHERE size <= 40"
_RECEIVE_LABELS = f"""
    SELECT id, name AS lable FROM {A.LABEL_SOURCE.sql()}
    UNION ALL SELECT id + 1000000000, kind FROM {A.LABEL_SOURCE.sql()}
"""
ORACLE["json_label_table"] = f"""
    SELECT id, lable, 0 AS field FROM ({_CARE_LABELS})
    UNION ALL SELECT id, lable, 1 FROM ({_RECEIVE_LABELS})
"""
ORACLE["custom_field_labels"] = f"""
    SELECT c.ticket_id, x.lable AS trang_thai_cham_soc, y.lable AS trang_thai_tiep_nhan
    FROM ({ORACLE['eav_pivot']}) c
    LEFT JOIN ({_CARE_LABELS}) x ON c.trang_thai_cham_soc = x.id
    LEFT JOIN ({_RECEIVE_LABELS}) y ON c.trang_thai_tiep_nhan = y.id
"""

# --- phones ---------------------------------------------------------------------


def _digits(column: str) -> str:
    return f"regexp_replace({column}, '[^0-9]', '', 'g')"


def _normalized(column: str) -> str:
    d = _digits(column)
    return f"""CASE
        WHEN regexp_full_match({d}, '84[0-9]{{9,10}}') THEN '0' || substr({d}, 3)
        WHEN regexp_full_match({d}, '0[0-9]{{9,10}}') THEN {d}
        WHEN regexp_full_match({d}, '[0-9]{{9,11}}') THEN '0' || {d} END"""


_CLEAN = f"(SELECT id, {_normalized('phone')} AS phone FROM {A.PHONES.sql()})"
ORACLE["phone_normalize"] = f"""
    SELECT id, {_digits('phone')} AS digits, {_normalized('phone')} AS phone FROM {A.PHONES.sql()}
"""
_KNOWN = " OR ".join(f"starts_with(phone, '{old}')" for old in PREFIXES)
_REWRITE = " ".join(
    f"WHEN starts_with(phone, '{old}') THEN '{new}' || substr(phone, {len(old) + 1})"
    for old, new in PREFIXES.items()
)
ORACLE["phone_valid"] = f"SELECT id, CASE WHEN {_KNOWN} THEN phone END AS phone FROM {_CLEAN}"
ORACLE["phone_fix_head"] = f"SELECT id, CASE {_REWRITE} END AS phone FROM {_CLEAN}"

# --- leads ----------------------------------------------------------------------

ORACLE["hotline_calls"] = f"""
    SELECT call_date AS dt, CAST(call_date AS DATE) AS date, phone, status, 'Hotline' AS channel
    FROM {A.HOTLINE.sql()} WHERE hotline = '1900' AND left(status, 1) = 'C'
"""


def _lead_branch(relation: str, /, **given: str) -> str:
    """All target columns of one source, in order; absent ones are null."""
    texts = (
        "status", "channel", "name", "email", "source", "gclid", "initial_utm_medium",
        "initial_utm_source", "campain", "from_landing", "shopify_order_id",
    )
    columns = [f"{given['dt']} AS dt", f"{given['date']} AS date", f"{given['phone']} AS phone"]
    columns += [f"CAST({given.get(name, 'NULL')} AS VARCHAR) AS {name}" for name in texts]
    return f"SELECT {', '.join(columns)} FROM {relation}"


def _form_branch(adapter: A.Adapter, label: str, gclid: str = "NULL") -> str:
    return _lead_branch(
        adapter.sql(), dt='"Date"', date='CAST("Date" AS DATE)', phone='"Phone"', channel="'Leads'",
        name='"Name"', email='"Email"', source=f"'{label}'", gclid=gclid,
    )


_SUBSCRIBED = """strptime(left("First Subscribed On", 19), '%Y-%m-%dT%H:%M:%S') - INTERVAL 7 HOURS"""
_BRANCHES = [
    _lead_branch(
        f"({ORACLE['hotline_calls']})", dt="dt", date="date", phone="phone", status="status",
        channel="channel",
    ),
    _lead_branch(
        A.MESSAGES.sql(), dt="strptime(date, '%d/%m/%Y')",
        date="CAST(strptime(date, '%d/%m/%Y') AS DATE)", phone="phone", name="name",
        channel="'Messages'",
    ),
    _form_branch(A.AD_FORMS, "LP Digital - FB Ads"),
    _form_branch(A.PARTNER_FORMS, "LP Digital - FB Ads 3rd1", '"Gclid"'),
    _form_branch(A.SECOND_PARTNER_FORMS, "LP Digital - FB Ads", '"Gclid"'),
    _lead_branch(
        A.SHOP_FORMS.sql(), dt=_SUBSCRIBED, date=f"CAST({_SUBSCRIBED} AS DATE)",
        phone='"Phone Number"', channel="'Leads'", email='"Email"',
        source="'LP Digital - Shopify Form'", gclid="gclid",
        initial_utm_medium="initial_utm_medium", initial_utm_source="initial_utm_source",
    ),
    _lead_branch(
        A.SALES_CALLS.sql(), dt="created_at", date="CAST(created_at AS DATE)", phone="customer_tel",
        channel="'Leads'", name="customer_name", email="customer_email", gclid="gclid",
        campain="campain", from_landing="from_landing", shopify_order_id="shopify_order_id",
        source="CASE WHEN shopify_order_id <> '0' THEN 'Shopify Order' ELSE 'LP EC' END",
    ),
]
ORACLE["lead_union"] = f"""
    SELECT * REPLACE ({_normalized('phone')} AS phone) FROM ({' UNION ALL '.join(_BRANCHES)})
"""
ORACLE["lead_dedup"] = f"""
    SELECT salescall_id, customer_name, customer_tel, customer_email, gclid, campain, created_at
    FROM (
        SELECT *, ROW_NUMBER() OVER (
            PARTITION BY customer_name, customer_tel, gclid, campain, created_at
            ORDER BY salescall_id) AS n
        FROM (SELECT * REPLACE (strftime(created_at, '%Y-%m-%d') AS created_at)
              FROM {A.ALL_SALES_CALLS.sql()}))
    WHERE n = 1
"""
ORACLE["date_parse"] = f"""
    SELECT id, CAST(strptime(plain, '%d/%m/%Y') AS DATE) AS plain,
           CAST(strptime(padded, '%d/%m/%Y') AS DATE) AS padded,
           strptime(left(zoned, 19), '%Y-%m-%dT%H:%M:%S') - INTERVAL 7 HOURS AS utc,
           CAST(try_strptime(bad, '%d/%m/%Y') AS DATE) AS bad
    FROM {A.RENDERED_DATES.sql()}
"""
ORACLE["post_meta"] = f"""
    SELECT p."ID" AS "ID", p.post_name AS telephone, m.meta_value AS data,
           strftime(p.post_date, '%Y-%m-%d') AS post_date
    FROM {A.POSTS.sql()} p LEFT JOIN {A.POST_META.sql()} m ON m.post_id = p."ID"
    WHERE p.post_type = '1-URGENT'
"""

# --- text -----------------------------------------------------------------------

ORACLE["employee_code"] = f"""
    SELECT id, regexp_extract(replace(employee_code, ' ', ''), '(VN[0-9]{{4}})', 1) AS code
    FROM {A.RESPONSES.sql()}
"""
ORACLE["trainer_explode"] = f"""
    WITH coded AS (
        SELECT *, regexp_extract_all(trainer, '(VN[0-9]{{4}})', 1) AS codes FROM {A.RESPONSES.sql()})
    SELECT CAST(p - 1 AS INT) AS position, codes[p] AS trainer,
           strftime(strptime("timestamp", '%d/%m/%Y %H:%M:%S'), '%Y-%m-%d') AS "timestamp",
           COALESCE(regexp_extract(replace(employee_code, ' ', ''), '(VN[0-9]{{4}})', 1), '')
               AS employee_code,
           '''' || COALESCE(phone, '') AS phone, CAST(id AS VARCHAR) AS id, course
    FROM (SELECT *, unnest(generate_series(1, len(codes))) AS p FROM coded)
"""
ORACLE["name_first_token"] = f"""
    SELECT id, split_part(name, ' ', 1) AS first_token FROM {A.ITEM_NAMES.sql()}
"""

# --- ads ------------------------------------------------------------------------

_REGION_KEY = "date_start, campaign_id, adset_id, ad_id, region"


def _picked(column: str, tracked: dict[str, str]) -> str:
    cases = ", ".join(
        f"CASE WHEN a.value.action_type = '{kind}' THEN a.value.value END AS {name}"
        for name, kind in tracked.items()
    )
    return f"""SELECT DISTINCT {_REGION_KEY}, {cases}
        FROM (SELECT {_REGION_KEY}, unnest({column}) AS a FROM {A.ADS.sql()})"""


ORACLE["ads_actions_unnest"] = _picked(
    "actions",
    {
        "offline_conversion_purchase": "offsite_conversion.fb_pixel_purchase",
        "new_messaging_conversations": "onsite_conversion.messaging_first_reply",
        "comments": "comment",
    },
)
ORACLE["ads_action_values_unnest"] = _picked(
    "action_values", {"offline_conversion_purchase_value": "offsite_conversion.fb_pixel_purchase"}
)
ORACLE["ads_actions_files"] = ORACLE["ads_actions_unnest"]


def _listed(column: str, kind: str) -> str:
    """Sum of the values of one type inside the array."""
    found = f"list_filter({column}, lambda a: a.value.action_type = '{kind}')"
    return f"CAST(list_sum(list_transform({found}, lambda a: a.value.value)) AS BIGINT)"


ORACLE["ads_actions_wide"] = f"""
    SELECT date_start, campaign_id, adset_id, ad_id, campaign_name, adset_name, ad_name, region, reach, cpm,
           frequency, objective, spend,
           {_listed('actions', 'offsite_conversion.fb_pixel_purchase')} AS offline_conversion_purchase,
           {_listed('actions', 'onsite_conversion.messaging_first_reply')} AS new_messaging_conversations,
           {_listed('actions', 'comment')} AS comments,
           {_listed('action_values', 'offsite_conversion.fb_pixel_purchase')} AS offline_conversion_purchase_value
    FROM {A.ADS.sql()}
"""
_RANKED = f"""
    SELECT date_start, campaign_id, adset_id, ad_id, MIN(event_type) AS conversion_rate_ranking,
           MAX(event_type) AS engagement_rate_ranking, CAST(COUNT(*) AS VARCHAR) AS quality_ranking
    FROM {A.RANKED_ADS.sql()} GROUP BY ALL HAVING COUNT(*) > 1
"""


def _same(alias: str, *columns: str) -> str:
    return " AND ".join(f"b.{c} = {alias}.{c}" for c in columns)


_AD = ("date_start", "campaign_id", "adset_id", "ad_id")
ORACLE["ads_actions_join"] = f"""
    SELECT b.date_start, b.campaign_name, b.adset_name, b.ad_name, b.region, b.reach, b.cpm,
           b.frequency, b.objective, b.spend, u.offline_conversion_purchase,
           u.new_messaging_conversations, u.comments, v.offline_conversion_purchase_value,
           r.conversion_rate_ranking, r.engagement_rate_ranking, r.quality_ranking
    FROM {A.ADS.sql()} b
    LEFT JOIN ({ORACLE['ads_actions_unnest']}) u ON {_same('u', *_AD, 'region')}
    LEFT JOIN ({ORACLE['ads_action_values_unnest']}) v ON {_same('v', *_AD, 'region')}
    LEFT JOIN ({_RANKED}) r ON {_same('r', *_AD)}
    ORDER BY b.date_start DESC, b.campaign_name, b.adset_name, b.ad_name, b.region
"""
_RATES = {"first": "1000000.0", "second": "1000000.0", "local": "(1000000.0 * 23395.0)"}
_ACCOUNTS = " UNION ALL ".join(
    f"""SELECT '{name}' AS account, day, campaign, adgroup, region, impressions, clicks,
        CAST(cost AS DOUBLE) / CAST({_RATES[name]} AS DOUBLE) AS cost, allconv, allconvvalue
        FROM {adapter.sql()}"""
    for name, adapter in A.GEO_ACCOUNTS.items()
)
ORACLE["ads_geo_cost"] = f"""
    SELECT c.account, c.day, c.campaign, c.adgroup, c.impressions, c.clicks, c.cost, c.allconv,
           c.allconvvalue, d."Name" AS region
    FROM ({_ACCOUNTS}) c LEFT JOIN {A.PLACES.sql()} d ON c.region = d."Criteria_ID"
"""

# --- stores ---------------------------------------------------------------------

_MALLS = f"""
    SELECT m."Location", r.r_name AS "Province", n.n_name AS "Districts", m."Promotion", m."Special",
           m."Likes"
    FROM {A.MALLS.sql()} m
    LEFT JOIN nation n ON m.nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""
ORACLE["store_mall_join"] = f"""
    SELECT s."Comp", m.* FROM {A.STORES.sql()} s LEFT JOIN ({_MALLS}) m ON s."Mall" = m."Location"
"""


def _counted(key: str, counted: str, name: str, having: str = "") -> str:
    return f"""SELECT "{key}", COUNT({counted}) AS {name} FROM ({ORACLE['store_mall_join']})
        WHERE "{key}" IS NOT NULL GROUP BY "{key}" {having} ORDER BY {name} DESC, "{key}" """


ORACLE["stores_by_brand"] = _counted("Comp", '"Location"', "stores")
for _key, _column in (("mall", "Location"), ("province", "Province"), ("district", "Districts")):
    ORACLE[f"stores_by_{_key}"] = _counted(_column, '"Comp"', "stores", 'HAVING COUNT("Comp") > 1')
for _key, _column in (("province", "Province"), ("district", "Districts")):
    ORACLE[f"malls_by_{_key}"] = _counted(_column, 'DISTINCT "Location"', "malls")
ORACLE["flag_filter"] = f"""
    SELECT * FROM ({ORACLE['store_mall_join']}) WHERE "Promotion" = 1 AND "Special" = 1
"""
ORACLE["top_malls"] = _counted("Location", '"Comp"', "stores") + " LIMIT 5"
ORACLE["likes_ranking"] = f"""
    SELECT "Location", "Likes" FROM ({_MALLS}) WHERE "Likes" > 1e4 ORDER BY "Likes" DESC, "Location"
"""
ORACLE["top_likes"] = f"""
    SELECT "Location", "Likes" FROM ({_MALLS})
    WHERE "Promotion" = 1 AND "Special" = 1 AND "Likes" > 1e4
    ORDER BY "Likes" DESC, "Location" LIMIT 5
"""

# --- forecast -------------------------------------------------------------------

_SERIES = f"""
    SELECT l.location_id, CAST(t.trandate AS DATE) AS trandate, {_total('net_amount')} AS sales
    {_SOLD} GROUP BY l.location_id, t.trandate
"""
_LATEST_FIRST = "ROW_NUMBER() OVER (PARTITION BY location_id ORDER BY trandate DESC)"
ORACLE["holdout_split"] = f"""
    SELECT location_id, trandate, sales, {_LATEST_FIRST} <= 40 AS is_holdout FROM ({_SERIES})
"""
ORACLE["scaler_fit"] = f"""
    SELECT location_id, MIN(sales) AS low, MAX(sales) AS high FROM ({ORACLE['holdout_split']})
    WHERE NOT is_holdout GROUP BY location_id
"""
_SCALED = f"""
    SELECT x.*, f.low, f.high, CASE WHEN f.high = f.low THEN 1.0 ELSE f.high - f.low END AS span,
           (x.sales - f.low) / CASE WHEN f.high = f.low THEN 1.0 ELSE f.high - f.low END AS scaled
    FROM ({ORACLE['holdout_split']}) x LEFT JOIN ({ORACLE['scaler_fit']}) f
      ON x.location_id = f.location_id
"""
ORACLE["scaler_apply"] = f"""
    SELECT location_id, trandate, sales, scaled, round(scaled * span + low, 4) AS unscaled
    FROM ({_SCALED})
"""
_BY_DAY = "PARTITION BY location_id ORDER BY trandate"
_BEFORE = f"({_BY_DAY} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"
ORACLE["lag_features"] = f"""
    SELECT * FROM (
        SELECT location_id, trandate, is_holdout, scaled AS label,
               LAG(scaled, 1) OVER ({_BY_DAY}) AS lag_1,
               LAG(scaled, 30) OVER ({_BY_DAY}) AS lag_30,
               round(SUM(scaled) OVER {_BEFORE}, 6) AS lag_sum,
               CAST(COUNT(scaled) OVER {_BEFORE} AS INT) AS n
        FROM ({_SCALED}))
    WHERE n = 30
"""
ORACLE["tail_window"] = f"""
    SELECT location_id, trandate, sales
    FROM (SELECT *, {_LATEST_FIRST} AS n FROM ({_SERIES})) WHERE n BETWEEN 2 AND 31
"""
_MEAN = f"CASE WHEN COUNT(sales) OVER {_BEFORE} = 30 THEN AVG(sales) OVER {_BEFORE} END"
_PREDICTED = f"SELECT *, {_LATEST_FIRST} AS n, {_MEAN} AS prediction FROM ({_SERIES})"
ORACLE["forecast_report"] = f"""
    WITH p AS ({_PREDICTED})
    SELECT location_id, trandate, 'history' AS segment, sales, CAST(NULL AS DOUBLE) AS prediction
    FROM p WHERE n BETWEEN 2 AND 7
    UNION ALL SELECT location_id, trandate, 'bridge', sales, NULL FROM p WHERE n <= 2
    UNION ALL SELECT location_id, trandate, 'latest', sales, round(prediction, 4) FROM p WHERE n = 1
"""
_ERROR = "CAST(sales - prediction AS DECIMAL(19,6))"
ORACLE["forecast_metrics"] = f"""
    SELECT location_id,
           round(CAST(SUM({_ERROR} * {_ERROR}) AS DOUBLE) / COUNT(prediction), 2) AS mse,
           CAST(SUM(abs({_ERROR})) AS DOUBLE) / COUNT(prediction) AS mae
    FROM ({_PREDICTED}) WHERE n <= 40 GROUP BY location_id
"""

# --- loads ----------------------------------------------------------------------

_LOADED = (
    ("sales_order", "sales_order", 6, None),
    ("tickets", "ticket_projection", 15, "care_soft_ticket_id"),
    ("ticket_custom_fields", "custom_field_labels", 3, "ticket_id"),
    ("call_logs", "call_log_projection", 13, "call_id"),
    ("leads", "lead_union", 14, None),
)


def _repeated(query: str, key: str | None) -> str:
    if key is None:
        return "CAST(NULL AS BIGINT)"
    return f"(SELECT COUNT(*) FILTER (n > 1) FROM (SELECT {key}, COUNT(*) AS n FROM ({ORACLE[query]}) GROUP BY {key}))"


# Only the contacts' date texts come in forms that may be unreadable.
_UNREADABLE = f"""(SELECT COUNT(*) FILTER (date IS NOT NULL AND try_strptime(date, '%d/%m/%Y') IS NULL)
    FROM {A.MESSAGES.sql()})"""
ORACLE["load_audit"] = " UNION ALL ".join(
    f"""SELECT '{table}' AS "table", COUNT(*) AS n_rows, CAST({columns} AS INT) AS n_cols,
            CAST({_UNREADABLE if table == 'leads' else 0} AS BIGINT) AS n_bad, {_repeated(query, key)} AS n_repeated
        FROM ({ORACLE[query]})"""
    for table, query, columns, key in _LOADED
)
ORACLE["stock_carried"] = ORACLE["stock_snapshot"]

# --- streams --------------------------------------------------------------------

ORACLE["lead_append"] = ORACLE["lead_union"]
ORACLE["first_calls_append"] = ORACLE["lead_dedup"]

# --- files ----------------------------------------------------------------------

ORACLE["lead_funnel_files"] = ORACLE["lead_union"]
ORACLE["sheet_export"] = ORACLE["lead_dedup"]
ORACLE["bad_dates"] = f"""
    SELECT 'messages' AS source, COUNT(*) AS n_rows,
           COUNT(*) FILTER (date IS NOT NULL AND try_strptime(date, '%d/%m/%Y') IS NULL) AS n_bad
    FROM {A.MESSAGES.sql()}
    UNION ALL
    SELECT 'rendered', COUNT(*), COUNT(*) FILTER (bad IS NOT NULL AND try_strptime(bad, '%d/%m/%Y') IS NULL)
    FROM {A.RENDERED_DATES.sql()}
"""
ORACLE["repeated_ids"] = " UNION ALL ".join(
    f"""SELECT '{name}' AS "table", COUNT({key}) AS n_ids, COUNT(*) FILTER (n > 1) AS n_repeated
        FROM (SELECT {key}, COUNT(*) AS n FROM {adapter.sql()} GROUP BY {key})"""
    for name, adapter, key in (
        ("inventory_items", A.INVENTORY_ITEMS, "item_id"),
        ("service_items", A.SERVICE_ITEMS, "item_id"),
        ("transaction_lines", A.LINES, "transaction_id"),
    )
)

# --- model ----------------------------------------------------------------------

_WINDOWED = f"""
    SELECT *, {_LATEST_FIRST} AS n, COUNT(scaled) OVER {_BEFORE} AS n_lags FROM ({_SCALED})
"""
ORACLE["forecast_holdout_rows"] = f"""
    SELECT location_id, trandate, sales AS real, n_lags = 30 AS predicted FROM ({_WINDOWED}) WHERE is_holdout
"""
ORACLE["forecast_latest_rows"] = f"""
    SELECT location_id, trandate, sales, n_lags = 30 AS predicted FROM ({_WINDOWED}) WHERE n = 1
"""
ORACLE["model_residuals"] = "SELECT CAST(lag AS INT) AS lag, CAST(0 AS DOUBLE) AS residual FROM range(31) t(lag)"


def _solved(equations: str) -> str:
    """Elimination of one column after the other; the last column is the right side."""
    cell = """CASE WHEN i = k + 1 THEN m[i][j] / m[k + 1][k + 1]
              ELSE m[i][j] - m[i][k + 1] * m[k + 1][j] / m[k + 1][k + 1] END"""
    return f"""
    WITH RECURSIVE days AS MATERIALIZED (
        SELECT *, LIST(scaled) OVER {_BEFORE} AS lags FROM ({_WINDOWED})),
    training AS MATERIALIZED (
        SELECT location_id, list_concat([1.0::DOUBLE], lags, [scaled]) AS x FROM days WHERE NOT is_holdout AND n_lags = 30),
    equations AS ({equations}),
    steps AS (
        SELECT location_id, 0 AS k, LIST(cells ORDER BY i) AS m
        FROM (SELECT location_id, i, LIST(cell ORDER BY j) AS cells FROM equations GROUP BY location_id, i)
        GROUP BY location_id
        UNION ALL
        SELECT location_id, k + 1, list_transform(range(1, len(m) + 1), lambda i:
            list_transform(range(1, len(m) + 2), lambda j: {cell}))
        FROM steps WHERE k < len(m)),
    solved AS (SELECT location_id, list_transform(m, lambda cells: cells[-1]) AS b FROM steps WHERE k = len(m))
    """


_GRID = "range(1, 32) a(i), range(1, 33) b(j)"
# One model per location: a penalty of a thousandth per window, none on the constant.
_BY_SERIES = _solved(f"""
    SELECT location_id, i, j, SUM(x[i] * x[j]) + CASE WHEN i = j AND i > 1 THEN 0.001 * COUNT(*) ELSE 0 END AS cell
    FROM training, {_GRID} GROUP BY location_id, i, j""")
# One model for all: lags and label about their means, the penalty in units of the spread of lag and label.
_POOLED = _solved("""
    SELECT 0 AS location_id, i, j, covar_pop(x[i + 1], x[j + 1])
           * CASE WHEN i = j THEN 1 + 1e-4 / (SELECT stddev_pop(x[32]) FROM training) ELSE 1 END AS cell
    FROM training, range(1, 31) a(i), range(1, 32) b(j) GROUP BY i, j""")
_OWN = "(list_dot_product(lags, s.b[2:]) + s.b[1]) * span + low"
_ANY = """(list_dot_product(lags, s.b) + (SELECT AVG(x[32] - list_dot_product(x[2:31], b)) FROM training, solved))
    * span + low"""
_OF_SERIES = "days d LEFT JOIN solved s ON d.location_id = s.location_id"


def _forecast(solved: str, joined: str, value: str, holdout: bool) -> str:
    real, predicted, chosen = ("real", "pred", "is_holdout") if holdout else ("sales", "prediction", "n = 1")
    return f"""{solved}
    SELECT d.location_id, trandate, sales AS {real}, CASE WHEN n_lags = 30 THEN round({value}, 0) END AS {predicted}
    FROM {joined} WHERE {chosen}"""


ORACLE["forecast_holdout"] = _forecast(_POOLED, "days d, solved s", _ANY, True)
ORACLE["forecast_latest"] = _forecast(_POOLED, "days d, solved s", _ANY, False)
ORACLE["series_forecast_holdout"] = _forecast(_BY_SERIES, _OF_SERIES, _OWN, True)
ORACLE["series_forecast_latest"] = _forecast(_BY_SERIES, _OF_SERIES, _OWN, False)
ORACLE["series_model_residuals"] = f"""
    SELECT location_id, CAST(lag AS INT) AS lag, CAST(0 AS DOUBLE) AS residual
    FROM (SELECT DISTINCT location_id FROM ({_WINDOWED}) WHERE NOT is_holdout AND n_lags = 30), range(31) t(lag)
"""
_COMPANY = f"SELECT 'all' AS location_id, trandate, sales FROM ({ORACLE['daily_sales']})"
ORACLE["company_report"] = f"""
    SELECT location_id AS series, * EXCLUDE (location_id)
    FROM ({ORACLE['forecast_report'].replace(_SERIES, _COMPANY)})
"""

# --- corpus ---------------------------------------------------------------------


def _words(column: str) -> str:
    return f"list_filter(regexp_split_to_array(lower(coalesce({column}, '')), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+'), lambda w: w <> '')"


def _phrases(texts: str, key: str) -> str:
    """Every phrase of up to four words with its place."""
    words = f"SELECT {key}, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM (SELECT {key}, {_words('text')} AS w FROM {texts})"
    phrase, parts = "word", []
    for n in range(1, 5):
        parts.append(f"SELECT {key}, p, {n} AS n, w{n} AS phrase FROM grams WHERE w{n} IS NOT NULL")
    columns = []
    for n in range(1, 5):
        columns.append(f"{phrase} AS w{n}")
        phrase += f" || ' ' || lead(word, {n}) OVER (PARTITION BY {key} ORDER BY p)"
    return f"WITH grams AS (SELECT {key}, p, {', '.join(columns)} FROM ({words})) {' UNION ALL '.join(parts)}"


# The longest listed phrase of each place; then steps take the words from the left.
_STOP = f"""
    WITH items AS (SELECT row_number() OVER () AS id, text FROM benchmark),
    listed AS (
        SELECT phrase FROM (SELECT DISTINCT id, phrase FROM ({_phrases('items', 'id')}))
        GROUP BY phrase HAVING COUNT(*) >= 0.05::DOUBLE * (SELECT COUNT(*) FROM benchmark)),
    places AS MATERIALIZED (
        SELECT doc_id, p, MAX(phrase) FILTER (n = 1) AS word, MAX(CASE WHEN l.phrase IS NULL THEN 0 ELSE n END) AS n
        FROM ({_phrases('documents', 'doc_id')}) g LEFT JOIN listed l USING (phrase) GROUP BY doc_id, p),
    digits AS (SELECT doc_id, string_agg(CAST(n AS VARCHAR), '' ORDER BY p) AS d FROM places GROUP BY doc_id),
    steps AS MATERIALIZED (
        SELECT doc_id, CAST(s[1] AS INT) AS n,
               SUM(len(s)) OVER (PARTITION BY doc_id ORDER BY k) - len(s) + 1 AS p
        FROM (SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) AS k
              FROM (SELECT doc_id, regexp_extract_all(d, '4...|3..|2.|[01]') AS l FROM digits))),
    per_doc AS (
        SELECT d.doc_id, d.lang, coalesce(len(g.d), 0) AS n_words, coalesce(f.n_phrases, 0) AS n_phrases,
               coalesce(f.covered, 0) AS covered
        FROM documents d LEFT JOIN digits g USING (doc_id) LEFT JOIN (
            SELECT doc_id, COUNT(*) FILTER (n > 0) AS n_phrases, SUM(n) AS covered FROM steps GROUP BY doc_id) f
            USING (doc_id))
"""
ORACLE["stop_phrase_counts"] = f"""{_STOP}
    SELECT lang, phrase, COUNT(*) AS n
    FROM steps JOIN ({_phrases('documents', 'doc_id')}) USING (doc_id, p, n) JOIN documents USING (doc_id)
    GROUP BY lang, phrase
"""
ORACLE["stop_phrase_totals"] = f"""{_STOP}
    SELECT lang, COUNT(*) AS n_docs, CAST(SUM(n_words) AS BIGINT) AS n_words,
           CAST(SUM(n_phrases) AS BIGINT) AS n_phrases, CAST(SUM(covered) AS BIGINT) AS n_stop_words,
           CAST(SUM(n_words) - SUM(covered) AS BIGINT) AS n_kept
    FROM per_doc GROUP BY lang
"""
ORACLE["stop_phrases_removed"] = f"""{_STOP}
    SELECT doc_id, CAST(n_words AS INT) AS n_words, coalesce(k.kept, '') AS kept
    FROM per_doc LEFT JOIN (
        SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept
        FROM steps s JOIN places USING (doc_id, p) WHERE s.n = 0 GROUP BY doc_id) k USING (doc_id)
"""
