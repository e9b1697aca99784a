"""Stock: daily movement, running balance and gaps between movements."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.functions.dates import days_before, local_day, local_day_start, month_start
from shopfloor.operators.align import unite
from shopfloor.schemas import ledger

# Stock accounts and the document types that move stock.
STOCK_ACCOUNTS = (365, 366, 367, 370, 371)
STOCK_TYPES = (
    "Credit Memo", "Invoice", "Item Fulfillment", "Inventory Adjustment", "Item Receipt",
)


@dataclass(frozen=True)
class StockRule:
    accounts: Sequence[int] = STOCK_ACCOUNTS
    types: Sequence[str] = STOCK_TYPES


def stock_movement(
    lines: DataFrame, headers: DataFrame, as_of: str, rule: StockRule = StockRule(), after: date | None = None
) -> DataFrame:
    """Moved count and amount per local day, location and item.

    Headers created before yesterday (seen from ``as_of``, on the source clock)
    count; with ``after`` only those of later local days, by a filter that the scan
    can use. Nulls become 0 before grouping, so a line without location or item
    is booked under key 0. The parent header and the item table of the source
    rule supply no column and are not read.
    """
    counted = F.col("transaction_type").isin(*rule.types) & (
        F.col("create_date") < days_before(as_of, 1).cast("timestamp_ntz")
    )
    if after is not None:
        counted = counted & (F.col("create_date") >= local_day_start(after + timedelta(days=1)))
    moved = headers.where(counted).select("transaction_id", local_day(F.col("create_date")).alias("create_date"))
    booked = lines.where(F.col("account_id").isin(*rule.accounts)).select(
        "transaction_id",
        *[F.coalesce(F.col(k), F.lit(0)).cast("bigint").alias(k) for k in ("location_id", "item_id")],
        *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in ("item_count", "net_amount")],
    )
    return (
        booked.join(moved, "transaction_id")
        .groupBy("create_date", "location_id", "item_id")
        .agg(*[F.sum(ledger(F.col(m))).alias(m) for m in ("item_count", "net_amount")])
    )


def created_from_parent(headers: DataFrame) -> DataFrame:
    """Each header with the header it was created from; null where there is none.

    Headers without a parent id match nothing. They go around the join, so that
    they do not all meet in the task of the null key.
    """
    parents = headers.select(
        F.col("transaction_id").alias("created_from_id"),
        F.col("tranid").alias("parent_tranid"),
        F.col("transaction_type").alias("parent_type"),
        F.col("create_date").cast("date").alias("parent_date"),
    )
    children = headers.select("transaction_id", "tranid", "created_from_id")
    derived = F.col("created_from_id").isNotNull()
    joined = children.where(derived).join(parents, "created_from_id", "left")
    return unite(joined, children.where(~derived)).select(
        "transaction_id", "tranid", "created_from_id", "parent_tranid", "parent_type", "parent_date"
    )


_MEASURES = ("item_count", "net_amount")


def _running(measure: str) -> Column:
    # One row per day in each group, so a group never exceeds the calendar.
    to_date = (
        Window.partitionBy("location_id", "item_id")
        .orderBy("create_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return F.sum(measure).over(to_date)


def _balances() -> list[Column]:
    return [_running(m).cast("bigint").alias(m) for m in _MEASURES]


def _gaps(before: Column | None = None) -> list[Column]:
    """``before``: the last movement day before the frame begins."""
    day = F.col("create_date")
    previous = F.lag(day).over(Window.partitionBy("location_id", "item_id").orderBy("create_date"))
    if before is not None:
        previous = F.coalesce(previous, before)
    first = month_start(day)
    return [
        previous.alias("shift"),
        F.datediff(day, previous).cast("double").alias("date_diff"),
        first.alias("som"),
        F.datediff(day, first).cast("bigint").alias("som_date_diff"),
    ]


_KEYS = ("create_date", "location_id", "item_id")


def stock_balance(movement: DataFrame) -> DataFrame:
    """Running count and amount per location and item, cut to whole numbers."""
    return movement.select(*_KEYS, *_balances())


def stock_gaps(movement: DataFrame) -> DataFrame:
    """Previous movement day, days since, first of month and days into the month."""
    return movement.select(*_KEYS, *_gaps())


def stock_snapshot(movement: DataFrame) -> DataFrame:
    """Balance and gaps together: one sort and one shuffle serve both."""
    return movement.select(*_KEYS, *_balances(), *_gaps())


def last_closed_day(as_of: str) -> date:
    """The last local day that is over at the end of the headers that count."""
    return date.fromisoformat(as_of) - timedelta(days=2)


def carry_forward(opening: DataFrame, movement: DataFrame) -> DataFrame:
    """The snapshot rows of ``movement``, whose days all follow those of ``opening``.

    ``opening`` holds exact balances and the last movement day per location and
    item, see ``close_day``; a pair that is not in it starts at 0.
    """
    start = opening.select(
        "location_id", "item_id", F.col("last_day"), *[F.col(m).alias(f"opening_{m}") for m in _MEASURES]
    )
    carried = [
        (F.coalesce(F.col(f"opening_{m}"), F.lit(0)) + _running(m)).cast("bigint").alias(m) for m in _MEASURES
    ]
    rows = movement.join(start, ["location_id", "item_id"], "left")
    return rows.select(*_KEYS, *carried, *_gaps(F.col("last_day")))


def close_day(opening: DataFrame, movement: DataFrame, day: date) -> DataFrame:
    """Opening balances for the day after ``day``: those of before plus all movement up to it."""
    moved = movement.where(F.col("create_date") <= F.lit(day)).withColumnRenamed("create_date", "last_day")
    both = unite(opening, moved.select("location_id", "item_id", *_MEASURES, "last_day"))
    return both.groupBy("location_id", "item_id").agg(
        *[F.sum(m).cast("decimal(38,4)").alias(m) for m in _MEASURES], F.max("last_day").alias("last_day")
    )
