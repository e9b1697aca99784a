"""Column contracts of the tables read and written, and the step that enforces them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Money and counts are summed as exact decimals, so that totals do not depend on row order.
LEDGER = T.DecimalType(28, 4)


_LONG, _INT, _DOUBLE = T.LongType(), T.IntegerType(), T.DoubleType()
_TEXT, _DATE, _TIME = T.StringType(), T.DateType(), T.TimestampNTZType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# --- sources -----------------------------------------------------------------

TRANSACTION_LINES = _schema(
    transaction_id=_LONG, item_id=_LONG, location_id=_LONG, account_id=_INT, item_count=_DOUBLE,
    net_amount=_DOUBLE,
)
TRANSACTIONS = _schema(
    transaction_id=_LONG, created_from_id=_LONG, trandate=_TIME, create_date=_TIME, tranid=_TEXT,
    customer_phone=_TEXT, transaction_type=_TEXT, status=_TEXT,
)
INVENTORY_ITEMS = _schema(item_id=_LONG, displayname=_TEXT)
SERVICE_ITEMS = _schema(item_id=_LONG)
TICKET_CUSTOM_FIELDS_EAV = _schema(ticket_id=_LONG, custom_filed_id=_INT, custom_filed_value=_TEXT)
CUSTOM_FIELDS_DOCUMENT = _schema(
    custom_fields=T.ArrayType(_schema(values=T.ArrayType(_schema(id=_LONG, lable=_TEXT))))
)
SALES_CALLS = _schema(
    salescall_id=_LONG, customer_name=_TEXT, customer_tel=_TEXT, customer_email=_TEXT, gclid=_TEXT,
    campain=_TEXT, from_landing=_TEXT, created_at=_TIME, shopify_order_id=_TEXT,
)
HOTLINE_CALLS = _schema(call_date=_TIME, phone=_TEXT, status=_TEXT, hotline=_TEXT)
MESSAGES_CSV = _schema(name=_TEXT, phone=_TEXT, date=_TEXT)
AD_LEADS_CSV = _schema(Date=_TIME, Name=_TEXT, Phone=_TEXT, Email=_TEXT)
AD_LEADS_GCLID_CSV = _schema(Date=_TIME, Name=_TEXT, Phone=_TEXT, Email=_TEXT, Gclid=_TEXT)
SHOP_FORM_CSV = _schema(
    **{
        "First Subscribed On": _TEXT,
        "Phone Number": _TEXT,
        "Email": _TEXT,
        "gclid": _TEXT,
        "initial_utm_medium": _TEXT,
        "initial_utm_source": _TEXT,
    }
)
POSTS = _schema(ID=_LONG, post_name=_TEXT, post_type=_TEXT, post_date=_TIME)
POST_META = _schema(post_id=_LONG, meta_value=_TEXT)
_ACTIONS = T.ArrayType(_schema(value=_schema(action_type=_TEXT, value=_LONG)))
ADS_INSIGHTS_REGION = _schema(
    date_start=_DATE, campaign_id=_LONG, campaign_name=_TEXT, adset_id=_LONG, adset_name=_TEXT,
    ad_id=_LONG, ad_name=_TEXT, region=_TEXT, reach=_LONG, cpm=_DOUBLE, frequency=_DOUBLE, objective=_TEXT,
    spend=_DOUBLE, actions=_ACTIONS, action_values=_ACTIONS,
)
ADS_INSIGHTS = _schema(
    date_start=_DATE, campaign_id=_LONG, adset_id=_LONG, ad_id=_LONG, conversion_rate_ranking=_TEXT,
    engagement_rate_ranking=_TEXT, quality_ranking=_TEXT,
)
GEO_PERFORMANCE = _schema(
    day=_DATE, campaign=_TEXT, adgroup=_TEXT, region=_LONG, impressions=_LONG, clicks=_LONG, cost=_LONG,
    allconv=_DOUBLE, allconvvalue=_DOUBLE,
)
LOCATION_NAMES = _schema(Criteria_ID=_LONG, Name=_TEXT)
STORE_LIST = _schema(Comp=_TEXT, Mall=_TEXT)
MALL_DIM = _schema(Location=_TEXT, Province=_TEXT, Districts=_TEXT, Promotion=_INT, Special=_INT, Likes=_LONG)

# --- targets -----------------------------------------------------------------

SALES_ORDER = _schema(
    TRANDATE=_DATE, TRANID=_TEXT, CUSTOMER_PHONE=_TEXT, LOCATION_ID=_DOUBLE, ITEM_COUNT=_DOUBLE,
    NET_AMOUNT=_DOUBLE,
)
TICKETS = _schema(
    care_soft_ticket_id=_LONG, ticket_no=_LONG, ticket_subject=_TEXT, ticket_status=_TEXT,
    ticket_source=_TEXT, ticket_priority=_TEXT, assignee_id=_LONG, requester_id=_LONG,
    requester_name=_TEXT, requester_email=_TEXT, requester_phone_no=_TEXT, sla=_TEXT, campaign_name=_TEXT,
    created_at=_TIME, updated_at=_TIME,
)
TICKET_CUSTOM_FIELDS = _schema(ticket_id=_LONG, trang_thai_cham_soc=_TEXT, trang_thai_tiep_nhan=_TEXT)
CALL_LOGS = _schema(
    call_id=_TEXT, care_soft_id=_LONG, customer_id=_LONG, ticket_id=_LONG, caller=_TEXT, agent_id=_LONG,
    group_id=_LONG, call_type=_LONG, call_status=_TEXT, start_time=_TIME, end_time=_TIME, created_at=_TIME,
    updated_at=_TIME,
)
LEADS = _schema(
    dt=_TIME, date=_DATE, phone=_TEXT, status=_TEXT, channel=_TEXT, name=_TEXT, email=_TEXT, source=_TEXT,
    gclid=_TEXT, initial_utm_medium=_TEXT, initial_utm_source=_TEXT, campain=_TEXT, from_landing=_TEXT,
    shopify_order_id=_TEXT,
)
INVENTORY_VALUATION = _schema(
    create_date=_DATE, location_id=_LONG, item_id=_LONG, item_count=_LONG, net_amount=_LONG, shift=_DATE,
    date_diff=_DOUBLE, som=_DATE, som_date_diff=_LONG,
)
OPENING_BALANCES = _schema(
    location_id=_LONG, item_id=_LONG, item_count=T.DecimalType(38, 4), net_amount=T.DecimalType(38, 4), last_day=_DATE,
)
LEAD_EXPORT = _schema(
    salescall_id=_LONG, customer_name=_TEXT, customer_tel=_TEXT, customer_email=_TEXT, gclid=_TEXT,
    campain=_TEXT, created_at=_TEXT,
)
POST_EXPORT = _schema(ID=_LONG, telephone=_TEXT, data=_TEXT, post_date=_TEXT)


def ledger(column: Column) -> Column:
    return column.cast(LEDGER)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the contract's columns by name (any case), in its order and types.

    Columns the contract does not name are dropped; a missing one is an error.
    """
    actual = {name.lower(): name for name in df.columns}
    missing = [f.name for f in schema if f.name.lower() not in actual]
    if missing:
        raise ValueError(f"columns missing from the frame: {missing}")
    return df.select(
        *[F.col(f"`{actual[f.name.lower()]}`").cast(f.dataType).alias(f.name) for f in schema]
    )
