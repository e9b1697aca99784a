"""The star-schema tables in the shape of the operators' inputs.

Every adapter is a projection over one table, written as SQL expressions that
both engines read. Where the engines spell something differently the column
holds a ``Both`` pair.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Both:
    spark: str
    ansi: str


@lru_cache(maxsize=64)
def _schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).schema


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table; its schema is looked up once per session, its files each time."""
    path = f"{folder}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


@dataclass(frozen=True)
class Adapter:
    table: str
    columns: dict[str, str | Both]
    where: str | None = None

    def frame(self, spark: SparkSession, folder: str) -> DataFrame:
        df = table(spark, folder, self.table)
        if self.where:
            df = df.where(self.where)
        if self.table == "events":
            df = df.selectExpr("*", f"{COUNTER} AS {K}")
        return df.selectExpr(
            *[f"{e.spark if isinstance(e, Both) else e} AS `{n}`" for n, e in self.columns.items()]
        )

    def sql(self) -> str:
        columns = ", ".join(
            f'{e.ansi if isinstance(e, Both) else e} AS "{n}"' for n, e in self.columns.items()
        )
        where = f" WHERE {self.where}" if self.where else ""
        rows = self.table
        if rows == "events":
            rows = f"(SELECT *, {COUNTER} AS {K} FROM events)"
        return f"(SELECT {columns} FROM {rows}{where})"


# The counter inside the events' JSON text, 0 to 99, as a column of its own.
COUNTER = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT)"
K = "counter"


def text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def phone_text(number: str) -> str:
    """Phones of every length and spelling, from an id."""
    nine = f"concat('9', lpad({text(f'{number} % 100000000')}, 8, '0'))"
    seven = f"lpad({text(f'{number} % 10000000')}, 7, '0')"
    return f"""CASE
        WHEN {number} % 16 = 15 THEN '12345'
        WHEN {number} % 8 = 0 THEN {nine}
        WHEN {number} % 8 = 1 THEN concat('0', {nine})
        WHEN {number} % 8 = 2 THEN concat('1', {nine})
        WHEN {number} % 8 = 3 THEN concat('0162', {seven})
        WHEN {number} % 8 = 4 THEN concat('84', {nine})
        WHEN {number} % 8 = 5 THEN concat('12', {nine})
        WHEN {number} % 8 = 6 THEN concat('840', {nine})
        ELSE concat('+84 ', substr({nine}, 1, 3), '-', substr({nine}, 4, 6)) END"""


def code_text(number: str) -> str:
    return f"concat('VN', lpad({text(f'{number} % 10000')}, 4, '0'))"


USER = text("user_id")
DAY_FIRST = Both("date_format(ts, 'd/M/yyyy')", "strftime(ts, '%-d/%-m/%Y')")


def zoned(moment: str) -> Both:
    return Both(
        f"concat(date_format({moment}, \"yyyy-MM-dd'T'HH:mm:ss\"), '+07:00')",
        f"concat(strftime({moment}, '%Y-%m-%dT%H:%M:%S'), '+07:00')",
    )


LINES = Adapter(
    "lineitem",
    {
        "transaction_id": "l_orderkey",
        "item_id": "l_partkey",
        "location_id": "l_suppkey",
        "account_id": "l_linenumber",
        "item_count": Both("-l_quantity", "CAST(-l_quantity AS DECIMAL(18,4))"),
        "net_amount": Both("-l_extendedprice", "CAST(-l_extendedprice AS DECIMAL(18,4))"),
    },
)
HEADERS = Adapter(
    "orders",
    {
        "transaction_id": "o_orderkey",
        "created_from_id": "CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_custkey * 12 END",
        "trandate": "o_orderdate",
        "create_date": "o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR",
        "tranid": f"concat('SO', {text('o_orderkey')})",
        "customer_phone": phone_text("o_custkey"),
        "transaction_type": "o_orderpriority",
        "status": "o_orderstatus",
    },
)
INVENTORY_ITEMS = Adapter(
    "part",
    {"item_id": "p_partkey", "displayname": "CASE WHEN p_brand = 'Brand#7' THEN NULL ELSE p_name END"},
    "p_size <= 25",
)
SERVICE_ITEMS = Adapter("part", {"item_id": "p_partkey"}, "p_type = 'PROMO'")

TICKETS = Adapter(
    "events",
    {
        "care_soft_ticket_id": "event_id",
        "ticket_no": "event_id + 100000",
        "ticket_subject": f"concat('Ticket ', {text('event_id')})",
        "ticket_status": "CASE WHEN event_type = 'error' THEN 'open' ELSE 'solved' END",
        "ticket_source": "event_type",
        "ticket_priority": f"CASE WHEN {K} < 10 THEN 'high' ELSE 'normal' END",
        "assignee_id": "user_id % 20",
        "requester_id": "user_id",
        "requester_name": f"concat('user ', {USER})",
        "requester_email": f"concat('user', {USER}, '@example.org')",
        "requester_phone_no": phone_text("user_id"),
        "sla": f"CASE WHEN {K} % 2 = 0 THEN 'met' ELSE NULL END",
        "campaign_name": f"concat('campaign ', {text(K)})",
        "created_at": "ts",
        "updated_at": f"ts + {K} * INTERVAL '1' MINUTE",
        "internal_note": "props",
        "score": "value",
    },
)
CALLS = Adapter(
    "events",
    {
        "id": "event_id",
        "call_id": f"concat('call-', {text('event_id')})",
        "care_soft_id": "event_id * 10",
        "customer_id": "user_id",
        "ticket_id": "event_id % 1000",
        "caller": phone_text("user_id"),
        "agent_id": "user_id % 20",
        "group_id": "user_id % 5",
        "call_type": f"{K} % 2",
        "call_status": "event_type",
        "start_time": "ts",
        "end_time": "ts + CAST(floor(value) AS INT) * INTERVAL '1' SECOND",
        "created_at": "ts",
        "updated_at": "ts + INTERVAL '1' HOUR",
    },
)
CUSTOM_FIELDS = Adapter(
    "events",
    {
        "ticket_id": "CAST(floor(event_id / 4) AS BIGINT)",
        "custom_filed_id": "CASE event_type WHEN 'click' THEN 4871 WHEN 'purchase' THEN 4893 "
        "WHEN 'view' THEN 4871 ELSE 5000 END",
        "custom_filed_value": f"CASE WHEN {K} % 17 = 0 THEN 'n/a' ELSE {text(K)} END",
    },
)

HOTLINE = Adapter(
    "events",
    {
        "call_date": "ts",
        "phone": phone_text("user_id"),
        "status": "concat(upper(substr(event_type, 1, 1)), substr(event_type, 2, 20))",
        "hotline": f"CASE WHEN {K} < 50 THEN '1900' ELSE '1800' END",
    },
)
MESSAGES = Adapter(
    "events",
    {"name": f"concat('user ', {USER})", "phone": phone_text("user_id"), "date": DAY_FIRST},
    "event_type = 'view'",
)


def _ad_form(gclid: bool, where: str) -> Adapter:
    columns = {
        "Date": "ts",
        "Name": f"concat('user ', {USER})",
        "Phone": phone_text("user_id"),
        "Email": f"concat('user', {USER}, '@example.org')",
    }
    if gclid:
        columns["Gclid"] = f"concat('g', {text('event_id')})"
    return Adapter("events", columns, where)


AD_FORMS = _ad_form(False, "event_type = 'signup'")
PARTNER_FORMS = _ad_form(True, "event_type = 'error' AND value < 10")
SECOND_PARTNER_FORMS = _ad_form(True, "event_type = 'error' AND value >= 10")
SHOP_FORMS = Adapter(
    "events",
    {
        "First Subscribed On": zoned("ts"),
        "Phone Number": phone_text("user_id"),
        "Email": f"concat('user', {USER}, '@example.org')",
        "gclid": f"concat('g', {text('event_id')})",
        "initial_utm_medium": "event_type",
        "initial_utm_source": f"concat('utm ', {text(K)})",
    },
    "event_type = 'purchase' AND value < 10",
)


def _sales_calls(where: str | None) -> Adapter:
    return Adapter(
        "events",
        {
            "salescall_id": "event_id",
            "customer_name": f"concat('user ', {USER})",
            "customer_tel": phone_text("user_id"),
            "customer_email": f"concat('user', {USER}, '-', event_type, '@example.org')",
            "gclid": f"CASE WHEN {K} < 30 THEN NULL ELSE concat('g', {text(f'{K} % 3')}) END",
            "campain": f"concat('campaign ', {text('user_id % 7')})",
            "from_landing": f"concat('page ', {text(K)})",
            "created_at": "ts",
            "shopify_order_id": f"CASE WHEN {K} < 20 THEN NULL WHEN {K} < 60 THEN '0' ELSE {text(K)} END",
        },
        where,
    )


SALES_CALLS = _sales_calls("event_type = 'purchase' AND value >= 10")
ALL_SALES_CALLS = _sales_calls(None)
RENDERED_DATES = Adapter(
    "orders",
    {
        "id": "o_orderkey",
        "plain": Both("date_format(o_orderdate, 'd/M/yyyy')", "strftime(o_orderdate, '%-d/%-m/%Y')"),
        "padded": Both("date_format(o_orderdate, 'dd/MM/yyyy')", "strftime(o_orderdate, '%d/%m/%Y')"),
        "zoned": zoned("o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR"),
        "bad": Both("date_format(o_orderdate, 'yyyy-dd-MM')", "strftime(o_orderdate, '%Y-%d-%m')"),
    },
)
POSTS = Adapter(
    "orders",
    {
        "ID": "o_orderkey",
        "post_name": phone_text("o_custkey"),
        "post_type": "o_orderpriority",
        "post_date": "o_orderdate",
    },
)
POST_META = Adapter(
    "lineitem",
    {"post_id": "l_orderkey", "meta_value": f"concat('gift ', l_returnflag, {text('l_linenumber')})"},
)
PHONES = Adapter("customer", {"id": "c_custkey", "phone": phone_text("c_custkey")})
RESPONSES = Adapter(
    "customer",
    {
        "id": "c_custkey",
        "timestamp": f"concat({text('c_custkey % 28 + 1')}, '/', {text('c_custkey % 12 + 1')}, '/2021 8:05:09')",
        "trainer": f"""CASE c_custkey % 6
            WHEN 0 THEN 'no code here'
            WHEN 1 THEN concat({code_text('c_custkey')}, ' - ', c_name)
            WHEN 2 THEN concat({code_text('c_custkey')}, ', ', {code_text('c_custkey + 1')})
            WHEN 3 THEN concat('vn', {text('c_custkey % 9000 + 1000')})
            WHEN 4 THEN concat({code_text('c_custkey')}, '9; ', {code_text('c_custkey + 2')}, ';', {code_text('c_custkey + 3')})
            ELSE NULL END""",
        "employee_code": f"""CASE c_custkey % 4
            WHEN 0 THEN concat('VN ', lpad({text('c_custkey % 10000')}, 4, '0'))
            WHEN 1 THEN concat('code ', {code_text('c_custkey')}, ' ok')
            WHEN 2 THEN 'unknown'
            ELSE NULL END""",
        "phone": f"CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE {phone_text('c_custkey')} END",
        "course": "c_mktsegment",
    },
)

GEO_COLUMNS = {
    "day": "CAST(l_shipdate AS DATE)",
    "campaign": f"concat('campaign ', {text('l_linenumber')})",
    "adgroup": "concat('group ', l_linestatus)",
    "region": "l_suppkey + l_linenumber - 3",
    "impressions": "CAST(l_quantity * 100 AS BIGINT)",
    "clicks": "CAST(l_quantity AS BIGINT)",
    "cost": "CAST(round(l_extendedprice * 100) AS BIGINT) * 10000",
    "allconv": "l_discount",
    "allconvvalue": "l_tax",
}
GEO_ACCOUNTS = {
    name: Adapter("lineitem", GEO_COLUMNS, f"l_returnflag = '{flag}'")
    for name, flag in (("first", "A"), ("second", "N"), ("local", "R"))
}
PLACES = Adapter("supplier", {"Criteria_ID": "s_suppkey", "Name": "s_name"})

_FIRST, _SECOND = f"CAST({K} % 3 + 1 AS BIGINT)", "CAST(user_id % 4 AS BIGINT)"
_PURCHASE, _REPLY = "offsite_conversion.fb_pixel_purchase", "onsite_conversion.messaging_first_reply"


def _entries(*entries: tuple[str, str]) -> Both:
    """An array of (action type, value) records in both spellings."""
    record = "array<struct<value:struct<action_type:string,value:bigint>>>"
    spark = ", ".join(
        f"named_struct('value', named_struct('action_type', '{kind}', 'value', {value}))"
        for kind, value in entries
    )
    ansi = ", ".join(f"{{'value': {{'action_type': '{kind}', 'value': {value}}}}}" for kind, value in entries)
    return Both(
        f"CAST(array({spark}) AS {record})",
        f'CAST([{ansi}] AS STRUCT("value" STRUCT(action_type VARCHAR, "value" BIGINT))[])',
    )


def _by_remainder(modulus: int, *cases: Both) -> Both:
    """One array per remainder of the counter; null for the remainders left over."""

    def render(side: str) -> str:
        branches = " ".join(f"WHEN {i} THEN {getattr(c, side)}" for i, c in enumerate(cases))
        return f"CASE {K} % {modulus} {branches} END"

    return Both(render("spark"), render("ansi"))


ADS = Adapter(
    "events",
    {
        "date_start": "CAST(ts AS DATE)",
        "campaign_id": "user_id % 20",
        "campaign_name": f"concat('campaign ', {text('user_id % 20')})",
        "adset_id": "user_id % 60",
        "adset_name": f"concat('set ', {text('user_id % 60')})",
        "ad_id": "user_id",
        "ad_name": f"concat('ad ', {USER})",
        "region": f"CASE WHEN {K} % 5 = 4 THEN NULL ELSE concat('R', {text(f'{K} % 5')}) END",
        "reach": f"CAST({K} * 10 AS BIGINT)",
        "cpm": "value / 4",
        "frequency": "value / 8",
        "objective": "event_type",
        "spend": "value",
        "actions": _by_remainder(
            6,
            _entries(),
            _entries(("comment", _FIRST)),
            _entries((_PURCHASE, _FIRST), ("comment", _SECOND)),
            _entries(("like", _FIRST), ("share", _SECOND)),
            _entries((_PURCHASE, _FIRST), (_PURCHASE, _FIRST), (_REPLY, _SECOND)),
        ),
        "action_values": _by_remainder(
            4,
            _entries((_PURCHASE, f"{_FIRST} * 100")),
            _entries(("add_to_cart", _SECOND)),
            _entries((_PURCHASE, _FIRST), (_PURCHASE, _SECOND)),
        ),
    },
)
RANKED_ADS = Adapter(
    "events",
    {
        "date_start": "CAST(ts AS DATE)",
        "campaign_id": "user_id % 20",
        "adset_id": "user_id % 60",
        "ad_id": "user_id",
        "event_type": "event_type",
    },
)
LABEL_SOURCE = Adapter(
    "part",
    {"id": "p_partkey", "size": "p_size", "kind": "concat(p_type, ' ', p_brand)", "name": "p_name"},
)
STORES = Adapter(
    "customer",
    {
        "Comp": "c_mktsegment",
        "Mall": f"concat('Supplier#', lpad({text('CAST(floor((c_custkey + 3 * c_nationkey) / 15) AS BIGINT)')}, 9, '0'))",
    },
)
MALLS = Adapter(
    "supplier",
    {
        "Location": "s_name",
        "nationkey": "s_nationkey",
        "Promotion": "CASE WHEN s_acctbal > 2000 THEN 1 ELSE 0 END",
        "Special": "CASE WHEN s_nationkey < 20 THEN 1 ELSE 0 END",
        "Likes": "CAST(floor(s_acctbal * 10) AS BIGINT)",
    },
)
ITEM_NAMES = Adapter("part", {"id": "p_partkey", "name": "p_name"})
STAMPS = Adapter("events", {"id": "event_id", "moment": "ts"})
