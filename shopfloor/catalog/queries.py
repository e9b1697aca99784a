"""Registered queries: operator calls on the adapted tables, whole tables throughout."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor import schemas
from shopfloor.catalog import adapters as A
from shopfloor.functions import dates, phone, text
from shopfloor.operators import ads, forecast, inventory, leads, phrases, sales, series_models, stores, tickets, training
from shopfloor.plans import forecasting, loads
from shopfloor.session import fresh_folder, materialize
from shopfloor.sinks import export_sheet, write_bucketed
from shopfloor.sources import read_csv, read_json_lines, read_table
from shopfloor.streaming import lead_append as streaming

Query = Callable[[SparkSession, str], DataFrame]

SALES_RULE = sales.SalesRule(
    accounts=(1, 2, 3, 4, 5), types=("1-URGENT", "2-HIGH", "3-MEDIUM"), closed="P", services=(12, 16)
)
STOCK_RULE = inventory.StockRule(
    accounts=(3, 4, 5, 6, 7), types=("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")
)
STOCK_AS_OF = "2001-01-01"
STOCK_DAYS = ("2000-12-30", "2000-12-31", STOCK_AS_OF)
SALES_AS_OF = "2001-08-02"
POST_TYPE = "1-URGENT"
HOTLINE = "1900"
SERIES = ("location_id",)
LEDGER_BUCKETS = 8
STOP_SHARE = 0.05

QUERIES: dict[str, Query] = {}


def _register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


# --- sales ----------------------------------------------------------------------


def _ledger(spark: SparkSession, folder: str) -> sales.Ledger:
    return sales.Ledger(
        lines=A.LINES.frame(spark, folder),
        headers=A.HEADERS.frame(spark, folder),
        inventory_items=A.INVENTORY_ITEMS.frame(spark, folder),
        service_items=A.SERVICE_ITEMS.frame(spark, folder),
    )


@_register
def sales_order(spark, folder):
    return sales.sales_order(_ledger(spark, folder), SALES_RULE)


@_register
def sales_order_bucketed(spark, folder):
    """Sales orders over a ledger that is stored by transaction."""
    base, tables = fresh_folder(spark, "ledger"), _ledger(spark, folder)

    def stored(name: str, df: DataFrame) -> DataFrame:
        table = f"{name}_{base.rsplit('-', 1)[-1]}"
        return write_bucketed(df, table, f"{base}/{name}", "transaction_id", LEDGER_BUCKETS)

    kept = replace(tables, lines=stored("lines", tables.lines), headers=stored("headers", tables.headers))
    return sales.sales_order(kept, SALES_RULE)


@_register
def daily_sales(spark, folder):
    return sales.daily_sales(_ledger(spark, folder), SALES_RULE).orderBy("trandate")


@_register
def daily_sales_orders(spark, folder):
    return sales.daily_sales_orders(_ledger(spark, folder), SALES_AS_OF, SALES_RULE).orderBy("trandate")


@_register
def conform_schema(spark, folder):
    return schemas.conform(sales_order(spark, folder), schemas.SALES_ORDER)


# --- inventory ------------------------------------------------------------------


def _movement(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.stock_movement(
        A.LINES.frame(spark, folder), A.HEADERS.frame(spark, folder), STOCK_AS_OF, STOCK_RULE
    )


@_register
def stock_movement(spark, folder):
    totals = {m: F.col(m).cast("double") for m in ("item_count", "net_amount")}
    return _movement(spark, folder).withColumns(totals)


@_register
def stock_balance(spark, folder):
    return inventory.stock_balance(_movement(spark, folder))


@_register
def stock_gaps(spark, folder):
    return inventory.stock_gaps(_movement(spark, folder))


@_register
def stock_snapshot(spark, folder):
    return schemas.conform(
        inventory.stock_snapshot(_movement(spark, folder)), schemas.INVENTORY_VALUATION
    )


@_register
def stock_carried(spark, folder):
    """The snapshot by three daily runs, each from the balances the one before left."""
    path = fresh_folder(spark, "stock-carried")
    lines, headers = A.LINES.frame(spark, folder), A.HEADERS.frame(spark, folder)
    for as_of in STOCK_DAYS:
        loads.carry_stock_snapshot(spark, lines, headers, as_of, path, STOCK_RULE)
    return schemas.conform(
        spark.read.schema(schemas.INVENTORY_VALUATION).parquet(f"{path}/days"), schemas.INVENTORY_VALUATION
    )


@_register
def self_join_parent(spark, folder):
    return inventory.created_from_parent(A.HEADERS.frame(spark, folder))


@_register
def local_day_shift(spark, folder):
    moment = F.col("moment")
    return A.STAMPS.frame(spark, folder).select(
        "id", moment.cast("date").alias("source_day"), dates.local_day(moment).alias("local_day")
    )


# --- tickets --------------------------------------------------------------------


@_register
def ticket_projection(spark, folder):
    return tickets.ticket_projection(A.TICKETS.frame(spark, folder))


@_register
def call_log_projection(spark, folder):
    return tickets.call_log_projection(A.CALLS.frame(spark, folder))


@_register
def eav_pivot(spark, folder):
    codes = _field_codes(spark, folder)
    return codes.select(*[F.col(c).cast("double").alias(c) if c != "ticket_id" else c for c in codes.columns])


def _field_codes(spark: SparkSession, folder: str) -> DataFrame:
    return tickets.custom_field_codes(A.CUSTOM_FIELDS.frame(spark, folder))


def _label_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The parts as JSON documents with two custom fields each, landed and read."""
    entry = "named_struct('id', {id}, 'lable', {label})"
    kind = entry.format(id="id", label="kind")
    names = ", ".join(
        (entry.format(id="id", label="name"), entry.format(id="id + 1000000000", label="kind"))
    )
    packed = A.LABEL_SOURCE.frame(spark, folder).selectExpr(
        f"""to_json(named_struct('custom_fields', array(
            named_struct('values', CASE WHEN size <= 40 THEN array({kind}) ELSE slice(array({kind}), 1, 0) END),
            named_struct('values', array({names}))))) AS document"""
    )
    folder = fresh_folder(spark, "label-documents")
    packed.write.text(folder)
    return read_json_lines(spark, folder, schemas.CUSTOM_FIELDS_DOCUMENT)


@_register
def json_label_table(spark, folder):
    documents = _label_documents(spark, folder)
    care, receive = (
        tickets.label_table(documents, i).withColumn("field", F.lit(i)) for i in (0, 1)
    )
    return care.unionByName(receive)


@_register
def custom_field_labels(spark, folder):
    documents = _label_documents(spark, folder)
    labelled = tickets.label_custom_fields(
        _field_codes(spark, folder), tickets.label_table(documents, 0), tickets.label_table(documents, 1)
    )
    return schemas.conform(labelled, schemas.TICKET_CUSTOM_FIELDS)


# --- leads ----------------------------------------------------------------------


@_register
def hotline_calls(spark, folder):
    return leads.hotline_calls(A.HOTLINE.frame(spark, folder), HOTLINE)


@_register
def lead_union(spark, folder):
    return leads.lead_union(*_lead_sources(spark, folder))


def _lead_sources(spark: SparkSession, folder: str) -> list[DataFrame]:
    return [
        hotline_calls(spark, folder),
        *[
            source.frame(spark, folder)
            for source in (
                A.MESSAGES, A.AD_FORMS, A.PARTNER_FORMS, A.SECOND_PARTNER_FORMS, A.SHOP_FORMS, A.SALES_CALLS,
            )
        ],
    ]


@_register
def lead_funnel_files(spark, folder):
    """The same leads, the five file sources landed as CSV and read by the job."""
    base = fresh_folder(spark, "lead-files")

    def land(name: str, rows: DataFrame) -> str:
        exact = rows.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        exact.csv(f"{base}/{name}", header=True, escape='"')
        return f"{base}/{name}"

    shown = {new: old for old, new in loads.MESSAGE_HEADERS.items()}
    files = loads.LeadFiles(
        messages=land("messages", A.MESSAGES.frame(spark, folder).withColumnsRenamed(shown)),
        ad_forms=land("ad", A.AD_FORMS.frame(spark, folder)),
        partner_forms=land("partner", A.PARTNER_FORMS.frame(spark, folder)),
        second_partner_forms=land("second", A.SECOND_PARTNER_FORMS.frame(spark, folder)),
        shop_forms=land("shop", A.SHOP_FORMS.frame(spark, folder)),
    )
    return loads.lead_funnel(
        spark, files, A.HOTLINE.frame(spark, folder), A.SALES_CALLS.frame(spark, folder), HOTLINE
    )


@_register
def bad_dates(spark, folder):
    """Date texts of two sources, one of them in another order than the rule expects."""
    return loads.bad_dates(
        {
            "messages": (A.MESSAGES.frame(spark, folder), "date", dates.parse_day_first(F.col("date"))),
            "rendered": (A.RENDERED_DATES.frame(spark, folder), "bad", dates.parse_day_first(F.col("bad"))),
        }
    )


@_register
def repeated_ids(spark, folder):
    ledger = _ledger(spark, folder)
    return loads.repeated_ids(
        {
            "inventory_items": (ledger.inventory_items, "item_id"),
            "service_items": (ledger.service_items, "item_id"),
            "transaction_lines": (ledger.lines, "transaction_id"),
        }
    )


@_register
def lead_dedup(spark, folder):
    return leads.lead_dedup(A.ALL_SALES_CALLS.frame(spark, folder))


@_register
def sheet_export(spark, folder):
    """First calls written as sheets of 500 lines and read back."""
    path = fresh_folder(spark, "sheets")
    export_sheet(schemas.conform(lead_dedup(spark, folder), schemas.LEAD_EXPORT), path, 500)
    return schemas.conform(read_csv(spark, path), schemas.LEAD_EXPORT)


@_register
def date_parse(spark, folder):
    return A.RENDERED_DATES.frame(spark, folder).select(
        "id",
        dates.parse_day_first(F.col("plain")).cast("date").alias("plain"),
        dates.parse_day_first(F.col("padded")).cast("date").alias("padded"),
        dates.parse_zoned_as_utc(F.col("zoned")).alias("utc"),
        dates.parse_day_first(F.col("bad")).cast("date").alias("bad"),
    )


@_register
def post_meta(spark, folder):
    return leads.post_meta(A.POSTS.frame(spark, folder), A.POST_META.frame(spark, folder), POST_TYPE)


@_register
def phone_normalize(spark, folder):
    return A.PHONES.frame(spark, folder).select(
        "id",
        phone.digits_only(F.col("phone")).alias("digits"),
        phone.normalize_phone(F.col("phone")).alias("phone"),
    )


def _clean_phones(spark: SparkSession, folder: str) -> DataFrame:
    return A.PHONES.frame(spark, folder).withColumn("phone", phone.normalize_phone(F.col("phone")))


@_register
def phone_valid(spark, folder):
    return _clean_phones(spark, folder).select("id", phone.known_prefix(F.col("phone")).alias("phone"))


@_register
def phone_fix_head(spark, folder):
    return _clean_phones(spark, folder).select("id", phone.rewrite_prefix(F.col("phone")).alias("phone"))


# --- text -----------------------------------------------------------------------


@_register
def employee_code(spark, folder):
    return A.RESPONSES.frame(spark, folder).select(
        "id", text.employee_code(F.col("employee_code")).alias("code")
    )


@_register
def trainer_explode(spark, folder):
    return training.trainer_rows(A.RESPONSES.frame(spark, folder))


@_register
def name_first_token(spark, folder):
    return A.ITEM_NAMES.frame(spark, folder).select(
        "id", text.first_token(F.col("name")).alias("first_token")
    )


# --- ads ------------------------------------------------------------------------


def _rankings(spark: SparkSession, folder: str) -> DataFrame:
    """Rankings for the ads with more than one event on a day."""
    return (
        A.RANKED_ADS.frame(spark, folder)
        .groupBy(*ads.AD_KEY)
        .agg(
            F.min("event_type").alias("conversion_rate_ranking"),
            F.max("event_type").alias("engagement_rate_ranking"),
            F.count(F.lit(1)).alias("n"),
        )
        .where("n > 1")
        .select(
            *ads.AD_KEY, "conversion_rate_ranking", "engagement_rate_ranking",
            F.col("n").cast("string").alias("quality_ranking"),
        )
    )


@_register
def ads_actions_unnest(spark, folder):
    return ads.tracked_actions(A.ADS.frame(spark, folder), "actions", ads.ACTION_COUNTS)


@_register
def ads_action_values_unnest(spark, folder):
    return ads.tracked_actions(A.ADS.frame(spark, folder), "action_values", ads.ACTION_VALUES)


@_register
def ads_actions_join(spark, folder):
    return ads.order_report(ads.ads_report(A.ADS.frame(spark, folder), _rankings(spark, folder)))


@_register
def ads_actions_wide(spark, folder):
    return ads.ads_wide(A.ADS.frame(spark, folder))


@_register
def ads_actions_files(spark, folder):
    """The actions read from landed files whose records have more fields than the contract."""
    path = fresh_folder(spark, "ads-files")
    more = F.transform("actions", lambda a: F.struct(a["value"].withField("window", F.lit("28d")).alias("value"), F.lit(1).alias("rank")))
    A.ADS.frame(spark, folder).withColumn("actions", more).write.parquet(path)
    return ads.tracked_actions(read_table(spark, path, schemas.ADS_INSIGHTS_REGION), "actions", ads.ACTION_COUNTS)


@_register
def ads_geo_cost(spark, folder):
    frames = {name: adapter.frame(spark, folder) for name, adapter in A.GEO_ACCOUNTS.items()}
    accounts = [
        ads.AdAccount("first", frames["first"]),
        ads.AdAccount("second", frames["second"]),
        ads.AdAccount("local", frames["local"], ads.LOCAL_RATE),
    ]
    return ads.geo_cost(accounts, A.PLACES.frame(spark, folder))


# --- stores ---------------------------------------------------------------------


def _stores(spark: SparkSession, folder: str) -> DataFrame:
    return A.STORES.frame(spark, folder)


def _malls(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = A.table(spark, folder, "nation"), A.table(spark, folder, "region")
    places = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").alias("nationkey"),
        F.col("r_name").alias("Province"),
        F.col("n_name").alias("Districts"),
    )
    return (
        A.MALLS.frame(spark, folder)
        .join(places, "nationkey", "left")
        .select("Location", "Province", "Districts", "Promotion", "Special", "Likes")
    )


@_register
def store_mall_join(spark, folder):
    return stores.store_mall_join(_stores(spark, folder), _malls(spark, folder))


def _per_mall(spark: SparkSession, folder: str) -> DataFrame:
    return stores.stores_per_mall(_stores(spark, folder), _malls(spark, folder))


def _register_counts() -> None:
    def count(operator, key, min_above) -> Query:
        return lambda spark, folder: operator(_per_mall(spark, folder), key, min_above=min_above)

    QUERIES["stores_by_brand"] = count(stores.stores_by, "Comp", None)
    QUERIES["stores_by_mall"] = count(stores.stores_by, "Location", 1)
    QUERIES["stores_by_province"] = count(stores.stores_by, "Province", 1)
    QUERIES["stores_by_district"] = count(stores.stores_by, "Districts", 1)
    QUERIES["malls_by_province"] = count(stores.malls_by, "Province", None)
    QUERIES["malls_by_district"] = count(stores.malls_by, "Districts", None)


_register_counts()


@_register
def flag_filter(spark, folder):
    return stores.allows_promotion(store_mall_join(spark, folder))


@_register
def top_malls(spark, folder):
    return stores.top_malls(_per_mall(spark, folder))


@_register
def likes_ranking(spark, folder):
    return stores.likes_ranking(_malls(spark, folder))


@_register
def top_likes(spark, folder):
    return stores.top_likes(_malls(spark, folder))


# --- forecast -------------------------------------------------------------------


def _series(spark: SparkSession, folder: str) -> DataFrame:
    return sales.daily_sales(_ledger(spark, folder), SALES_RULE, SERIES)


def _split(spark: SparkSession, folder: str) -> DataFrame:
    return forecast.holdout_split(_series(spark, folder), SERIES)


@_register
def holdout_split(spark, folder):
    return _split(spark, folder)


@_register
def scaler_fit(spark, folder):
    return forecast.scaler_fit(_split(spark, folder), SERIES)


@_register
def scaler_apply(spark, folder):
    split = _split(spark, folder)
    return forecast.scaler_apply(split, forecast.scaler_fit(split, SERIES), SERIES).select(
        *SERIES, "trandate", "sales", "scaled",
        F.round(forecast.unscale(F.col("scaled"), F.col("low"), F.col("high")), 4).alias("unscaled"),
    )


def _lags(spark: SparkSession, folder: str) -> DataFrame:
    return forecast.lag_features(forecast.fit_and_scale(_split(spark, folder), SERIES), SERIES)


@_register
def lag_features(spark, folder):
    total = F.aggregate("lags", F.lit(0.0), lambda a, x: a + x)
    return _lags(spark, folder).select(
        *SERIES, "trandate", "is_holdout",
        F.col("scaled").alias("label"),
        F.element_at("lags", -1).alias("lag_1"),
        F.element_at("lags", 1).alias("lag_30"),
        F.round(total, 6).alias("lag_sum"),
        F.size("lags").alias("n"),
    )


@_register
def tail_window(spark, folder):
    return forecast.tail_window(_series(spark, folder), SERIES)


@_register
def forecast_report(spark, folder):
    predicted = forecast.mean_of_lags(_series(spark, folder), SERIES)
    report = forecast.forecast_report(predicted, SERIES)
    return report.withColumn("prediction", F.round("prediction", 4))


@_register
def forecast_metrics(spark, folder):
    predicted = forecast.mean_of_lags(_split(spark, folder), SERIES).where("is_holdout")
    return forecast.forecast_metrics(predicted, SERIES).withColumn("mse", F.round("mse", 2))


def _rounded(predicted: DataFrame, column: str) -> DataFrame:
    """Predictions in whole units of money, so that the last digits of two solvers agree."""
    return predicted.withColumn(column, F.round(column, 0) + 0.0)


@_register
def forecast_holdout(spark, folder):
    windows, trained = forecasting.train_forecaster(_series(spark, folder), SERIES)
    return _rounded(forecast.forecast_holdout(windows, trained.model, SERIES), "pred")


@_register
def forecast_latest(spark, folder):
    series = materialize(_series(spark, folder), "daily-series")
    saved = fresh_folder(spark, "forecaster")
    forecasting.train_and_save(series, SERIES, saved)
    return _rounded(forecasting.score_latest(spark, series, saved), "prediction")


@_register
def forecast_holdout_rows(spark, folder):
    """Days, real values and which of them got a prediction."""
    return forecast_holdout(spark, folder).select(*SERIES, "trandate", "real", F.col("pred").isNotNull().alias("predicted"))


@_register
def forecast_latest_rows(spark, folder):
    return forecast_latest(spark, folder).select(
        *SERIES, "trandate", "sales", F.col("prediction").isNotNull().alias("predicted")
    )


@_register
def model_residuals(spark, folder):
    """A fit without penalty leaves no error along any lag."""
    windows = materialize(_lags(spark, folder), "lag-windows")
    model = forecast.fit_model(windows, penalty=0.0)
    return forecast.normal_residuals(windows, model).select(
        "lag", (F.round("residual", 6) + 0.0).alias("residual")
    )


@_register
def series_forecast_holdout(spark, folder):
    """Holdout days predicted by the model of their own location."""
    windows, models = forecasting.train_series_models(_series(spark, folder), SERIES)
    return _rounded(series_models.predict_holdout(windows, models, SERIES), "pred")


@_register
def series_forecast_latest(spark, folder):
    """Models of all locations saved, read back and used on the latest day."""
    series = materialize(_series(spark, folder), "daily-series")
    saved = fresh_folder(spark, "series-models")
    forecasting.save_series_models(series, SERIES, saved)
    return _rounded(forecasting.score_latest_by_series(spark, series, SERIES, saved), "prediction")


@_register
def series_model_residuals(spark, folder):
    """Every equation of every location's fit holds."""
    windows, models = forecasting.train_series_models(_series(spark, folder), SERIES)
    return series_models.series_residuals(windows, models, SERIES).withColumn(
        "residual", F.round("residual", 6) + 0.0
    )


@_register
def company_report(spark, folder):
    """The report on the sales of all locations together."""
    daily = sales.daily_sales(_ledger(spark, folder), SALES_RULE)
    predicted = forecast.mean_of_lags(forecast.single_series(daily), ("series",))
    report = forecast.forecast_report(predicted, ("series",))
    return report.withColumn("prediction", F.round("prediction", 4))


# --- corpus ---------------------------------------------------------------------


def _stop_matched(spark: SparkSession, folder: str) -> DataFrame:
    """The documents against the phrases that a twentieth of the benchmark items hold."""
    listed = phrases.frequent_phrases(A.table(spark, folder, "benchmark"), STOP_SHARE)
    return phrases.match_phrases(A.table(spark, folder, "documents").select("doc_id", "lang", "text"), listed)


@_register
def stop_phrase_counts(spark, folder):
    return phrases.phrase_counts(_stop_matched(spark, folder), ("lang",))


@_register
def stop_phrase_totals(spark, folder):
    return phrases.word_totals(_stop_matched(spark, folder), ("lang",))


@_register
def stop_phrases_removed(spark, folder):
    return _stop_matched(spark, folder).select(
        "doc_id", F.size("words").alias("n_words"), F.array_join("kept", " ").alias("kept")
    )


# --- loads ----------------------------------------------------------------------


@_register
def load_audit(spark, folder):
    sources = loads.Sources(
        ledger=_ledger(spark, folder),
        tickets=A.TICKETS.frame(spark, folder),
        ticket_fields=A.CUSTOM_FIELDS.frame(spark, folder),
        field_labels=_label_documents(spark, folder),
        call_logs=A.CALLS.frame(spark, folder),
        leads=leads.lead_union(*_lead_sources(spark, folder), problems=True),
    )
    return loads.load_warehouse(
        spark, fresh_folder(spark, "warehouse"), loads.nightly_tables(sources, SALES_RULE)
    )


@_register
def lead_append(spark, folder):
    """The leads of all sources, landed with raw phones and appended by the stream."""
    base = fresh_folder(spark, "lead-append")
    leads.lead_rows(*_lead_sources(spark, folder)).write.parquet(f"{base}/landed")
    streaming.append_leads(spark, f"{base}/landed", f"{base}/leads", f"{base}/state").awaitTermination()
    return schemas.conform(spark.read.parquet(f"{base}/leads"), schemas.LEADS)


@_register
def first_calls_append(spark, folder):
    """First call per person, click id, campaign and day, by the stream."""
    base = fresh_folder(spark, "first-calls")
    # Three runs, each with a third of the calls of every day.
    for turn in range(3):
        calls = A.ALL_SALES_CALLS.frame(spark, folder).where(F.pmod(F.hash("salescall_id"), F.lit(3)) == turn)
        calls.write.mode("append").parquet(f"{base}/landed")
        streaming.append_first_calls(
            spark, f"{base}/landed", f"{base}/staged", f"{base}/calls", f"{base}/state"
        ).awaitTermination()
    return schemas.conform(spark.read.schema(schemas.LEAD_EXPORT).parquet(f"{base}/calls"), schemas.LEAD_EXPORT)
