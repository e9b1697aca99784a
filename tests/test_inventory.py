from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan_of
from shopfloor import schemas as S
from shopfloor.operators.inventory import (
    created_from_parent,
    stock_balance,
    stock_gaps,
    stock_movement,
    stock_snapshot,
)
from shopfloor.plans.loads import load_stock_snapshot


@pytest.fixture(scope="module")
def headers(spark):
    kind = "Invoice"
    return spark.createDataFrame(
        [
            (1, None, None, datetime(2021, 1, 30, 10, 0), "T1", None, kind, "Open"),
            (2, 1, None, datetime(2021, 1, 31, 17, 30), "T2", None, kind, "Open"),  # next local day
            (3, 1, None, datetime(2021, 2, 27, 12, 0), "T3", None, "Item Receipt", "Open"),
            (4, 9, None, datetime(2021, 3, 9, 23, 59), "T4", None, kind, "Open"),  # day before the cut
            (5, None, None, datetime(2021, 3, 10, 0, 0), "T5", None, kind, "Open"),  # at the cut
            (6, None, None, datetime(2021, 1, 30, 10, 0), "T6", None, "Sales Order", "Open"),
        ],
        S.TRANSACTIONS,
    )


@pytest.fixture(scope="module")
def movement(spark, headers):
    lines = spark.createDataFrame(
        [
            (1, 5, 7, 365, 2.0, 10.75),
            (1, 5, 7, 371, 1.0, 0.5),
            (2, 5, 7, 365, -5.0, -20.5),
            (3, 5, 7, 365, None, None),
            (4, 5, 7, 365, 1.0, 1.0),
            (1, None, None, 365, 4.0, 4.0),
            (5, 5, 7, 365, 100.0, 100.0),
            (6, 5, 7, 365, 100.0, 100.0),
            (1, 5, 7, 480, 100.0, 100.0),
        ],
        S.TRANSACTION_LINES,
    )
    return stock_movement(lines, headers, "2021-03-11")


def test_movement(movement, rows):
    assert rows(movement.select("create_date", "location_id", "item_id", F.col("net_amount").cast("double"))) == [
        (date(2021, 1, 30), 0, 0, 4.0),
        (date(2021, 1, 30), 7, 5, 11.25),
        (date(2021, 2, 1), 7, 5, -20.5),
        (date(2021, 2, 27), 7, 5, 0.0),
        (date(2021, 3, 10), 7, 5, 1.0),
    ]


def test_balance_is_cut_toward_zero(movement, rows):
    assert rows(stock_balance(movement.where("item_id = 5")), "create_date", "item_count", "net_amount") == [
        (date(2021, 1, 30), 3, 11),
        (date(2021, 2, 1), -2, -9),
        (date(2021, 2, 27), -2, -9),
        (date(2021, 3, 10), -1, -8),
    ]


def test_gaps(movement, rows):
    got = rows(stock_gaps(movement), "create_date", "item_id", "shift", "date_diff", "som", "som_date_diff")
    assert got == [
        (date(2021, 1, 30), 0, None, None, date(2021, 1, 1), 29),
        (date(2021, 1, 30), 5, None, None, date(2021, 1, 1), 29),
        (date(2021, 2, 1), 5, date(2021, 1, 30), 2.0, date(2021, 2, 1), 0),
        (date(2021, 2, 27), 5, date(2021, 2, 1), 26.0, date(2021, 2, 1), 26),
        (date(2021, 3, 10), 5, date(2021, 2, 27), 11.0, date(2021, 3, 1), 9),
    ]


def test_last_balance_is_the_total(spark, data):
    """The running sum ends at the group total, on the whole table."""
    from shopfloor.catalog.queries import _movement

    movement = _movement(spark, data)
    keys = ["location_id", "item_id"]
    last = stock_balance(movement).groupBy(*keys).agg(F.max_by("net_amount", "create_date").alias("last"))
    total = movement.groupBy(*keys).agg(F.sum("net_amount").cast("bigint").alias("total"))
    assert last.join(total, keys).where("last <> total").count() == 0


def test_snapshot_needs_one_window_and_one_sort(movement):
    plan = plan_of(stock_snapshot(movement))
    assert plan.count("Window [") == 1
    assert plan.split("HashAggregate")[0].count("Sort [") == 1


def test_parents(headers, rows):
    got = rows(created_from_parent(headers), "transaction_id", "created_from_id", "parent_tranid", "parent_date")
    assert got == [
        (1, None, None, None),
        (2, 1, "T1", date(2021, 1, 30)),
        (3, 1, "T1", date(2021, 1, 30)),
        (4, 9, None, None),
        (5, None, None, None),
        (6, None, None, None),
    ]


def test_partitioned_load(spark, headers, tmp_path, rows):
    lines = spark.createDataFrame([(1, 5, 7, 365, 2.0, 10.75), (2, 5, 7, 365, 1.0, 1.0)], S.TRANSACTION_LINES)
    path = str(tmp_path / "valuation")
    load_stock_snapshot(lines, headers, "2021-03-11", path)
    load_stock_snapshot(lines.where("transaction_id = 2"), headers, "2021-03-11", path)
    back = spark.read.parquet(path)
    assert sorted(back.columns) == sorted(S.INVENTORY_VALUATION.names)
    assert [p.name for p in (tmp_path / "valuation").glob("create_date=*")] == ["create_date=2021-02-01"]
    assert rows(back, "location_id", "item_id", "item_count", "net_amount") == [(7, 5, 1, 1)]
