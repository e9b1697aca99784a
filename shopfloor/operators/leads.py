"""Lead funnel: shape each source, unite them by name, clean phones, remove copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.functions.dates import day_text, parse_day_first, parse_zoned_as_utc
from shopfloor.functions.phone import normalize_phone
from shopfloor.functions.text import starts_with
from shopfloor.operators.align import lower_names, unite
from shopfloor.schemas import LEADS

# Channel and source names of the funnel.
CALLS, MESSAGES, FORMS = "Hotline", "Messages", "Leads"
AD_FORM = "LP Digital - FB Ads"
AD_FORM_PARTNER = "LP Digital - FB Ads 3rd1"
SHOP_FORM = "LP Digital - Shopify Form"
SHOP_ORDER, SALES_DESK = "Shopify Order", "LP EC"


def hotline_calls(calls: DataFrame, hotline: str, status_prefix: str = "C") -> DataFrame:
    """Calls to one hotline whose status starts with the prefix."""
    return calls.where(
        (F.col("hotline") == hotline) & starts_with(F.col("status"), status_prefix)
    ).select(
        F.col("call_date").alias("dt"),
        F.col("call_date").cast("date").alias("date"),
        "phone", "status",
        F.lit(CALLS).alias("channel"),
    )


def unreadable(text: Column, parsed: Column) -> Column:
    """``problem``: the date text that no rule could read, which the load makes null."""
    return F.when(text.isNotNull() & parsed.isNull(), text).alias("problem")


def message_leads(messages: DataFrame) -> DataFrame:
    """Chat contacts with a day-first date text."""
    moment = parse_day_first(F.col("date"))
    return messages.select(
        "name", "phone", moment.cast("date").alias("date"), moment.alias("dt"),
        F.lit(MESSAGES).alias("channel"), unreadable(F.col("date"), moment),
    )


def ad_leads(leads: DataFrame, source: str) -> DataFrame:
    """Ad form entries, with or without a click id; column names in any case."""
    return (
        lower_names(leads)
        .withColumnRenamed("date", "dt")
        .withColumns({"date": F.col("dt").cast("date"), "source": F.lit(source)})
    )


def shop_form_leads(leads: DataFrame) -> DataFrame:
    """Shop sign-ups; the zoned time is kept as the UTC wall clock."""
    return (
        leads.withColumnsRenamed(
            {"First Subscribed On": "dt", "Phone Number": "phone", "Email": "email"}
        )
        .withColumn("problem", unreadable(F.col("dt"), parse_zoned_as_utc(F.col("dt"))))
        .withColumn("dt", parse_zoned_as_utc(F.col("dt")))
        .withColumns({"date": F.col("dt").cast("date"), "source": F.lit(SHOP_FORM)})
    )


def sales_call_leads(calls: DataFrame) -> DataFrame:
    """Sales desk calls; one that led to a shop order is tagged so."""
    ordered = F.col("shopify_order_id") != "0"
    return calls.select(
        F.col("customer_name").alias("name"),
        F.col("customer_tel").alias("phone"),
        F.col("customer_email").alias("email"),
        "gclid", "campain", "from_landing",
        F.col("created_at").alias("dt"),
        F.col("created_at").cast("date").alias("date"),
        F.col("shopify_order_id").cast("string").alias("shopify_order_id"),
        F.when(ordered, SHOP_ORDER).otherwise(SALES_DESK).alias("source"),
    )


def lead_union(
    calls: DataFrame,
    messages: DataFrame,
    ad_forms: DataFrame,
    partner_forms: DataFrame,
    second_partner_forms: DataFrame,
    shop_forms: DataFrame,
    desk_calls: DataFrame,
    problems: bool = False,
) -> DataFrame:
    """The whole funnel from shaped and raw sources, with phones normalised."""
    rows = lead_rows(
        calls, messages, ad_forms, partner_forms, second_partner_forms, shop_forms, desk_calls, problems
    )
    return rows.withColumn("phone", normalize_phone(F.col("phone")))


def lead_rows(
    calls: DataFrame,
    messages: DataFrame,
    ad_forms: DataFrame,
    partner_forms: DataFrame,
    second_partner_forms: DataFrame,
    shop_forms: DataFrame,
    desk_calls: DataFrame,
    problems: bool = False,
) -> DataFrame:
    """All sources in the shape of the target, phones as they came.

    The second partner carries the label of the house ads, as in the source
    rule. No shuffle: every branch is a scan and a projection. With ``problems``
    there is one more column, the date text that could not be read.
    """
    forms = unite(
        ad_leads(ad_forms, AD_FORM),
        ad_leads(partner_forms, AD_FORM_PARTNER),
        ad_leads(second_partner_forms, AD_FORM),
        shop_form_leads(shop_forms),
        sales_call_leads(desk_calls),
    ).withColumn("channel", F.lit(FORMS))
    everything = unite(calls, message_leads(messages), forms)
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in LEADS]
    return everything.select(*columns, *(["problem"] if problems else []))


def lead_dedup(calls: DataFrame) -> DataFrame:
    """First call (lowest id) per name, phone, click id, campaign and day; nulls compare equal.

    An aggregate instead of a ranked window: tasks drop copies before the
    shuffle, so a key with very many copies costs one row per task.
    """
    return first_of_day(calls.withColumn("created_at", day_text(F.col("created_at"))))


def first_of_day(calls: DataFrame) -> DataFrame:
    """The same for calls whose time is a day already. First calls of parts give those of the whole."""
    keys = ["customer_name", "customer_tel", "gclid", "campain", "created_at"]
    return (
        calls.groupBy(*keys)
        .agg(F.min(F.struct("salescall_id", "customer_email")).alias("first"))
        .select(
            "first.salescall_id", "customer_name", "customer_tel", "first.customer_email",
            "gclid", "campain", "created_at",
        )
    )


def _hashed(small: DataFrame) -> DataFrame:
    """Asks for a hash join on ``small`` unless Spark may broadcast it.

    Sorting both sides would take memory for all rows a task gets; this takes it
    for the smaller side alone.
    """
    most = small.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = int(str(small._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return small if size <= most else small.hint("shuffle_hash")


def post_meta(posts: DataFrame, meta: DataFrame, post_type: str) -> DataFrame:
    """Posts of one type with each of their meta values; posts without any survive once.

    Written as matches plus posts without a match. An outer join could neither
    broadcast the few chosen posts nor split one post with very many values;
    the inner join can do both. The unmatched part reads only the ids of values,
    cut to those of chosen posts before they are made distinct. Posts too many to
    broadcast are hashed, so that no task sorts its meta values.
    """
    chosen = posts.where(F.col("post_type") == post_type).select(
        "ID", F.col("post_name").alias("telephone"), day_text(F.col("post_date")).alias("post_date")
    )
    values = meta.select(F.col("post_id").alias("ID"), F.col("meta_value").alias("data"))
    matched = _hashed(chosen).join(values, "ID")
    with_meta = values.select("ID").join(_hashed(chosen.select("ID")), "ID", "left_semi").distinct()
    unmatched = chosen.join(_hashed(with_meta), "ID", "left_anti").withColumn("data", F.lit(None).cast("string"))
    return matched.unionByName(unmatched).select("ID", "telephone", "data", "post_date")
