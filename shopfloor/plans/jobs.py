"""The scheduled jobs, from source tables to committed targets.

A ``Reader`` turns a logical table name into a DataFrame, so the same job runs
over a database or over landed Parquet.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shopfloor import schemas
from shopfloor.operators import inventory, sales
from shopfloor.operators.align import lower_names
from shopfloor.plans import forecasting, loads
from shopfloor.session import materialize, working_tables
from shopfloor.sinks.versions import publish
from shopfloor.sources import (
    jdbc_options,
    read_csv,
    read_jdbc_table,
    read_json_documents,
    read_table,
)
from shopfloor.sources.jdbc import Split

Reader = Callable[[str], DataFrame]

# Headers of the training form.
TRAINING_HEADERS = {
    "Timestamp": "timestamp",
    "Tên Trainer phụ trách khóa đào tạo (có thể chọn nhiều)": "trainer",
    "Mã số nhân viên ": "employee_code",
    "Số điện thoại": "phone",
}


def folder_reader(spark: SparkSession, folder: str, names: Mapping[str, str] | None = None) -> Reader:
    """Tables as Parquet data sets ``<folder>/<name>``."""
    known = names or {}
    return lambda table: lower_names(read_table(spark, f"{folder}/{known.get(table, table)}"))


def jdbc_reader(
    spark: SparkSession,
    prefix: str,
    database: str | None = None,
    names: Mapping[str, str] | None = None,
    splits: Mapping[str, Split] | None = None,
    small: Sequence[str] = (),
) -> Reader:
    """Tables of a database whose connection stands in the environment.

    ``names`` maps logical to physical names; ``splits`` says how to read tables in
    parallel. One task reads a table without a split, so such a table must be
    named in ``small``.
    """
    options = jdbc_options(prefix, database)
    known, ranges = names or {}, splits or {}

    def read(table: str) -> DataFrame:
        if table not in ranges and table not in small:
            raise ValueError(f"say how to split {table}, or that it is small")
        return lower_names(read_jdbc_table(spark, options, known.get(table, table), ranges.get(table)))

    return read


def read_ledger(read: Reader) -> sales.Ledger:
    return sales.Ledger(
        lines=read("transaction_lines"),
        headers=read("transactions"),
        inventory_items=read("inventory_items"),
        service_items=read("service_items"),
    )


@dataclass(frozen=True)
class Nightly:
    """Inputs of the nightly load besides the ledger."""

    support: Reader
    field_labels: str
    lead_files: loads.LeadFiles
    hotline: str


def nightly_load(
    spark: SparkSession,
    ledger: Reader,
    inputs: Nightly,
    target: str,
    rule: sales.SalesRule = sales.SalesRule(),
) -> DataFrame:
    """Replace the five warehouse tables; returns rows, columns, bad dates and repeated ids of each."""
    read = inputs.support
    leads = loads.lead_funnel(
        spark, inputs.lead_files, read("hotline_calls"), read("sales_calls"), inputs.hotline, problems=True
    )
    sources = loads.Sources(
        ledger=read_ledger(ledger),
        tickets=read("tickets"),
        ticket_fields=read("ticket_custom_fields"),
        field_labels=read_json_documents(spark, inputs.field_labels, schemas.CUSTOM_FIELDS_DOCUMENT),
        call_logs=read("call_logs"),
        leads=leads,
    )
    return loads.load_warehouse(spark, target, loads.nightly_tables(sources, rule))


def stock_load(
    ledger: Reader, as_of: str, target: str, rule: inventory.StockRule = inventory.StockRule()
) -> None:
    loads.load_stock_snapshot(
        ledger("transaction_lines"), ledger("transactions"), as_of, target, rule
    )


def daily_stock_load(
    spark: SparkSession,
    ledger: Reader,
    as_of: str,
    target: str,
    rule: inventory.StockRule = inventory.StockRule(),
) -> None:
    """The stock snapshot by the days that are new since the last run."""
    with working_tables(spark):
        loads.carry_stock_snapshot(
            spark, ledger("transaction_lines"), ledger("transactions"), as_of, target, rule
        )


def sheet_exports(shop: Reader, landing: Reader, post_type: str, target: str) -> dict[str, int]:
    """Lead and post sheets; returns the rows written."""
    return {
        "leads": loads.export_leads(shop("sales_calls"), f"{target}/leads"),
        "posts": loads.export_posts(landing("posts"), landing("post_meta"), post_type, f"{target}/posts"),
    }


def training_export(spark: SparkSession, responses: str, target: str) -> int:
    rows = read_csv(spark, responses).withColumnsRenamed(TRAINING_HEADERS)
    return loads.export_training(rows, target)


def train_sales_forecast(
    ledger: Reader, state: str, rule: sales.SalesRule = sales.SalesRule(), keys: tuple[str, ...] = ("location_id",)
) -> DataFrame:
    """Fit on all days, save the state, return the holdout predictions."""
    series = materialize(sales.daily_sales(read_ledger(ledger), rule, keys), "daily-series")
    return forecasting.train_and_save(series, keys, state)


def train_series_forecasts(
    spark: SparkSession,
    ledger: Reader,
    state: str,
    target: str,
    rule: sales.SalesRule = sales.SalesRule(),
    keys: tuple[str, ...] = ("location_id",),
) -> None:
    """Fit one model per series, save them, and replace the holdout predictions in ``target``."""
    with working_tables(spark):
        series = materialize(sales.daily_sales(read_ledger(ledger), rule, keys), "daily-series")
        publish(spark, target, forecasting.save_series_models(series, keys, state).write.parquet)


def score_series_forecasts(
    spark: SparkSession,
    ledger: Reader,
    state: str,
    rule: sales.SalesRule = sales.SalesRule(),
    keys: tuple[str, ...] = ("location_id",),
) -> DataFrame:
    """Actual and predicted sales of the latest day, each series by its own saved model."""
    series = sales.daily_sales(read_ledger(ledger), rule, keys)
    return forecasting.score_latest_by_series(spark, series, keys, state)


def score_sales_forecast(
    spark: SparkSession,
    ledger: Reader,
    state: str,
    rule: sales.SalesRule = sales.SalesRule(),
    keys: tuple[str, ...] = ("location_id",),
) -> DataFrame:
    """Actual and predicted sales of the latest day."""
    series = sales.daily_sales(read_ledger(ledger), rule, keys)
    return forecasting.score_latest(spark, series, state)

