from __future__ import annotations

from datetime import date, datetime

import pytest

from tests.helpers import plan_of
from shopfloor import schemas as S
from shopfloor.operators.sales import Ledger, daily_sales, daily_sales_orders, sales_order

DAY, NEXT = datetime(2021, 5, 1), datetime(2021, 5, 2)


@pytest.fixture(scope="module")
def tables(spark):
    lines = [
        (1, 10, 7, 480, -2.0, -100.5),
        (1, 10, 7, 482, -1.0, -0.25),
        (1, 136263, 7, 480, -1.0, -10.0),  # listed service, no stock item
        (1, 99, 7, 480, -1.0, -999.0),  # service not listed
        (1, 11, 7, 480, -1.0, -999.0),  # stock item without a name
        (1, 10, 7, 1, -1.0, -999.0),  # other account
        (2, 10, None, 480, None, -5.0),  # no location, no count
        (3, 10, 7, 480, -1.0, -999.0),  # closed
        (4, 10, 7, 480, -1.0, -999.0),  # no status
        (5, 10, 7, 480, -1.0, -999.0),  # other type
        (6, 10, 7, 480, -1.0, -999.0),  # no header
        (7, 10, 7, 480, -3.0, -30.0),
        (None, 10, 7, 480, -1.0, -999.0),
    ]
    headers = [
        (1, None, DAY, DAY, "SO1", "091", "Sales Order", "Open"),
        (2, None, DAY, DAY, "SO2", None, "Sales Order", "Open"),
        (3, None, DAY, DAY, "SO3", "091", "Sales Order", "Closed"),
        (4, None, DAY, DAY, "SO4", "091", "Sales Order", None),
        (5, None, DAY, DAY, "SO5", "091", "Invoice", "Open"),
        # Same visible keys as order 1, other creation time: stays a row of its own.
        (7, None, DAY, NEXT, "SO1", "091", "Sales Order", "Open"),
        (8, None, NEXT, NEXT, "SO8", "091", "Sales Order", "Open"),
    ]
    return Ledger(
        spark.createDataFrame(lines, S.TRANSACTION_LINES),
        spark.createDataFrame(headers, S.TRANSACTIONS),
        spark.createDataFrame([(10, "bed"), (11, None)], S.INVENTORY_ITEMS),
        spark.createDataFrame([(136263,), (99,)], S.SERVICE_ITEMS),
    )


def test_sales_order(tables, rows):
    assert rows(sales_order(tables)) == [
        (date(2021, 5, 1), "SO1", "091", 7, 3.0, 30.0),
        (date(2021, 5, 1), "SO1", "091", 7, 4.0, 110.75),
        (date(2021, 5, 1), "SO2", None, None, None, 5.0),
    ]


def test_daily_totals(tables, rows):
    assert rows(daily_sales(tables)) == [(date(2021, 5, 1), 145.75)]
    assert rows(daily_sales_orders(tables, "2021-05-31")) == [(date(2021, 5, 1), 145.75, 2)]
    assert rows(daily_sales_orders(tables, "2021-06-01")) == []


def test_series_per_location(tables, rows):
    assert rows(daily_sales(tables, series_keys=["location_id"])) == [
        (None, date(2021, 5, 1), 5.0),
        (7, date(2021, 5, 1), 140.75),
    ]


def test_header_join_is_inner_and_lines_are_combined_first(tables):
    plan = plan_of(daily_sales(tables))
    assert "LeftOuter" not in plan
    assert "LeftSemi" in plan
    join, before = plan.index("Inner"), plan.index("partial_sum(cast(net_amount")
    assert join < before  # deeper in the tree, so earlier in the run


def test_bucketed_ledger_joins_without_a_shuffle(spark, data, tmp_path):
    from dataclasses import replace

    from shopfloor.catalog.queries import SALES_RULE, _ledger
    from shopfloor.sinks import write_bucketed

    tables = _ledger(spark, data)
    stored = {
        name: write_bucketed(getattr(tables, name), f"bucketed_{name}", str(tmp_path / name), "transaction_id", 8)
        for name in ("lines", "headers")
    }
    # As for a ledger too large to broadcast.
    kept = replace(tables, lines=stored["lines"], headers=stored["headers"].hint("merge"))
    orders = sales_order(kept, SALES_RULE)
    plan = plan_of(orders)
    join = plan[plan.index("SortMergeJoin [transaction_id"):]
    assert "Bucketed: true" in join and "hashpartitioning(transaction_id" not in plan
    assert len(list((tmp_path / "lines").glob("*.parquet"))) == 8
    plain = sales_order(tables, SALES_RULE)
    assert orders.exceptAll(plain).count() == 0 == plain.exceptAll(orders).count()
