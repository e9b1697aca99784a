"""Sales orders: ledger lines joined to headers, summed with the sign flipped."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.functions.dates import days_before
from shopfloor.schemas import ledger

# Revenue accounts, document type, excluded status and the
# service items that count as sales.
REVENUE_ACCOUNTS = (480, 482, 487, 498, 505, 508, 509, 510, 511, 54, 1079, 1170)
SALES_TYPES = ("Sales Order",)
CLOSED_STATUS = "Closed"
SOLD_SERVICES = (136263, 136264)


@dataclass(frozen=True)
class SalesRule:
    """Which lines and headers are sales."""

    accounts: Sequence[int] = REVENUE_ACCOUNTS
    types: Sequence[str] = SALES_TYPES
    closed: str = CLOSED_STATUS
    services: Sequence[int] = SOLD_SERVICES


@dataclass(frozen=True)
class Ledger:
    """Source tables. Item ids are unique in each item table."""

    lines: DataFrame
    headers: DataFrame
    inventory_items: DataFrame
    service_items: DataFrame


def _revenue_lines(ledger_tables: Ledger, rule: SalesRule) -> DataFrame:
    return ledger_tables.lines.where(F.col("account_id").isin(*rule.accounts))


def keep_sold(lines: DataFrame, ledger_tables: Ledger, rule: SalesRule) -> DataFrame:
    """Lines whose item is a named stock item or a listed service.

    Both item tables are outer-joined in the source rule and kept by
    ``name IS NOT NULL OR id IN (...)``. With unique item ids that is a
    membership test: one semi join against the union of both id sets instead of
    two outer joins. The line side stays unshuffled when the ids are small
    enough for Spark to broadcast; otherwise adaptive execution splits hot items.
    """
    named = ledger_tables.inventory_items.where(F.col("displayname").isNotNull()).select("item_id")
    listed = ledger_tables.service_items.where(F.col("item_id").isin(*rule.services)).select("item_id")
    return lines.join(named.unionByName(listed), "item_id", "left_semi")


def sold_lines(ledger_tables: Ledger, rule: SalesRule) -> DataFrame:
    return keep_sold(_revenue_lines(ledger_tables, rule), ledger_tables, rule)


def _sales_headers(headers: DataFrame, rule: SalesRule) -> DataFrame:
    return headers.where(F.col("transaction_type").isin(*rule.types) & (F.col("status") != rule.closed))


def _total_per_transaction(lines: DataFrame) -> DataFrame:
    """Amount per transaction before the header join.

    The tasks that read the lines combine first, so a transaction with very
    many lines reaches the join as a few rows. The sums already lie on the join
    key: the join moves them no further.
    """
    return lines.groupBy("transaction_id").agg(F.sum(ledger(F.col("net_amount"))).alias("net_amount"))


def _flipped(measure: Column) -> Column:
    return (-F.sum(measure)).cast("double")


def sales_order(tables: Ledger, rule: SalesRule = SalesRule()) -> DataFrame:
    """Count and amount per order, location and phone, ledger sign flipped.

    The creation time is a key but not an output, so visible keys may repeat.
    Lines without a header have no type and drop out, hence the inner join;
    adaptive execution can split a hot transaction on either side of it.
    Summing per transaction and location first was slower: it rarely shrinks
    the lines and costs one more shuffle.
    """
    return (
        sold_lines(tables, rule)
        .join(_sales_headers(tables.headers, rule), "transaction_id")
        .groupBy("trandate", "create_date", "tranid", "location_id", "customer_phone")
        .agg(*[_flipped(ledger(F.col(m))).alias(m) for m in ("item_count", "net_amount")])
        .select(
            F.col("trandate").cast("date").alias("trandate"),
            "tranid", "customer_phone", "location_id", "item_count", "net_amount",
        )
    )


def daily_sales(
    tables: Ledger, rule: SalesRule = SalesRule(), series_keys: Sequence[str] = ()
) -> DataFrame:
    """Amount per day, optionally per series key of the lines (such as the location)."""
    lines = sold_lines(tables, rule)
    headers = _sales_headers(tables.headers, rule).select(
        "transaction_id", F.col("trandate").cast("date").alias("trandate")
    )
    if series_keys:
        joined, amount = lines.join(headers, "transaction_id"), ledger(F.col("net_amount"))
    else:
        joined, amount = _total_per_transaction(lines).join(headers, "transaction_id"), F.col("net_amount")
    return joined.groupBy(*series_keys, "trandate").agg(_flipped(amount).alias("sales"))


def daily_sales_orders(
    tables: Ledger, as_of: str, rule: SalesRule = SalesRule(), days: int = 30
) -> DataFrame:
    """Amount and number of distinct orders per day, for the last ``days`` days.

    Few headers remain, so they are joined first: Spark broadcasts them, or
    filters the lines by them before the shuffle if they are still too many.
    """
    headers = (
        _sales_headers(tables.headers, rule)
        .where(F.col("trandate") >= days_before(as_of, days).cast("timestamp_ntz"))
        .select("transaction_id", "tranid", F.col("trandate").cast("date").alias("trandate"))
    )
    recent = _revenue_lines(tables, rule).join(headers, "transaction_id")
    return (
        keep_sold(recent, tables, rule)
        .groupBy("trandate")
        .agg(
            _flipped(ledger(F.col("net_amount"))).alias("sales"),
            F.count_distinct("tranid").alias("orders"),
        )
    )
