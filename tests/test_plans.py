"""What the plans must look like to hold at scale."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from shopfloor.catalog.queries import QUERIES


def formatted(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def read_columns(plan: str, table: str) -> set[str]:
    """Columns read from the table, over all its scans."""
    scans = [s for s in plan.split("\n\n") if f"/{table}.parquet" in s]
    return {c for s in scans for c in re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*)>", s).group(1))}


@pytest.mark.parametrize(
    ("name", "table", "columns", "pushed"),
    [
        ("daily_sales", "lineitem", {"l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice"}, "In(l_linenumber"),
        ("daily_sales_orders", "orders", {"o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority"},
         "GreaterThanOrEqual(o_orderdate"),
        ("stock_movement", "orders", {"o_orderkey", "o_orderdate", "o_orderpriority"}, "In(o_orderpriority"),
        ("post_meta", "orders", {"o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"},
         "EqualTo(o_orderpriority,1-URGENT)"),
        ("phone_normalize", "customer", {"c_custkey"}, ""),
    ],
)
def test_scans_read_little(spark, data, name, table, columns, pushed):
    plan = formatted(QUERIES[name](spark, data))
    assert read_columns(plan, table) == columns
    assert pushed in plan


NO_SHUFFLE = (
    "ticket_projection", "call_log_projection", "hotline_calls", "lead_union", "date_parse", "phone_normalize",
    "phone_valid", "phone_fix_head", "employee_code", "trainer_explode", "name_first_token", "local_day_shift",
    "json_label_table",
)


@pytest.mark.parametrize("name", NO_SHUFFLE)
def test_row_rules_move_no_rows(spark, data, name):
    assert "Exchange" not in formatted(QUERIES[name](spark, data))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"load_audit", "lead_append", "first_calls_append"}))
def test_no_python_and_no_pair_joins(spark, data, name):
    """No Python worker, no cross join and no single-task window in any plan."""
    plan = formatted(QUERIES[name](spark, data))
    for bad in ("Python", "Pandas", "CartesianProduct", "NestedLoopJoin"):
        assert bad not in plan
    # All locations together are one series, a row per calendar day.
    if "Window" in plan and name != "company_report":
        assert "SinglePartition" not in plan


@pytest.mark.parametrize(
    ("name", "shuffles"),
    # Shuffles of a plan without broadcast joins: both join sides, then the aggregate, then windows.
    [("daily_sales", 6), ("stock_movement", 3), ("stock_snapshot", 4), ("lead_dedup", 1), ("eav_pivot", 1),
     ("self_join_parent", 2), ("ads_geo_cost", 2), ("holdout_split", 6)],
)
def test_number_of_shuffles(spark, data, name, shuffles):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = formatted(QUERIES[name](spark, data))
    finally:
        spark.conf.set(key, before)
    assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == shuffles
