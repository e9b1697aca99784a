"""The scheduled jobs end to end, over landed files."""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shopfloor import schemas as S
from shopfloor.operators import inventory, sales
from shopfloor.plans import jobs
from shopfloor.plans import loads as nightly
from shopfloor.plans.loads import LeadFiles
from shopfloor.session import shared_folder
from shopfloor.sinks import current, read_current

T = datetime(2021, 3, 4, 5, 6)


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """A small shop: 80 days of orders at two locations, support tables and files."""
    root = tmp_path_factory.mktemp("landed")

    def put(name, rows, schema):
        frame = spark.createDataFrame(rows, schema)
        frame.toDF(*[c.upper() for c in frame.columns]).write.parquet(str(root / name))

    days = [datetime(2021, 1, 1) + timedelta(days=i) for i in range(80)]
    put("transaction_lines", [
        (2 * d + s, 10, 7 + s, account, -1.0, -100.0 - 7 * (d % 9) - s)
        for d in range(80) for s in (0, 1) for account in (480, 365)
    ], S.TRANSACTION_LINES)
    put("transactions", [
        (2 * d + s, None, day, day, f"SO{2 * d + s}", "091", "Sales Order" if d % 2 == 0 or s == 0 else "Invoice", "Open")
        for d, day in enumerate(days) for s in (0, 1)
    ], S.TRANSACTIONS)
    put("inventory_items", [(10, "bed")], S.INVENTORY_ITEMS)
    put("service_items", [(136263,)], S.SERVICE_ITEMS)
    put("tickets", [(1, 2, *["x"] * 4, 3, 4, *["x"] * 5, T, T)], S.TICKETS)
    put("ticket_custom_fields", [(1, 4871, "1"), (1, 4893, "7"), (2, 4871, "9")], S.TICKET_CUSTOM_FIELDS_EAV)
    put("call_logs", [("c", 1, 2, 3, "x", 4, 5, 6, "ok", T, T, T, T)], S.CALL_LOGS)
    put("hotline_calls", [(T, "912345678", "C", "1900")], S.HOTLINE_CALLS)
    put("sales_calls", [(i, "a", "912345678", None, None, None, None, T, "0") for i in (1, 2)], S.SALES_CALLS)
    put("posts", [(1, "091", "gift", T)], S.POSTS)
    put("post_meta", [(1, "a"), (1, "b")], S.POST_META)
    (root / "fields.json").write_text(json.dumps({"custom_fields": [
        {"values": [{"id": 1, "lable": "new"}]}, {"values": [{"id": 7, "lable": "taken"}]}]}))
    files = {
        "messages": "Tên,Phone(raw),Date(raw)\nan,0912345678,31/12/2020\nbo,0912345679,2020/31\n",
        "ad_forms": "Date,Name,Phone,Email\n2021-03-04,b,912345678,b@x\nsoon,c,912345670,c@x\n",
        "partner_forms": "Date,Name,Phone,Email,Gclid\n",
        "second_partner_forms": "Date,Name,Phone,Email,Gclid\n",
        "shop_forms": "First Subscribed On,Phone Number,Email,gclid,initial_utm_medium,initial_utm_source\n",
    }
    for name, body in files.items():
        (root / f"{name}.csv").write_text(body)
    headers = ",".join(f'"{h}"' for h in (*jobs.TRAINING_HEADERS, "Khóa"))
    (root / "training.csv").write_text(f'{headers}\n3/4/2021 8:05:09,"VN0001, VN0002",VN 0003,091,x\n')
    return root


@pytest.fixture
def read(spark, landed):
    return jobs.folder_reader(spark, str(landed))


def test_nightly_load(spark, landed, read, tmp_path, rows):
    files = LeadFiles(**{name: str(landed / f"{name}.csv") for name in LeadFiles.__annotations__})
    inputs = jobs.Nightly(read, str(landed / "fields.json"), files, "1900")
    audit = jobs.nightly_load(spark, read, inputs, str(tmp_path))
    assert rows(audit) == [
        ("call_logs", 1, 13, 0, 0), ("leads", 7, 14, 2, None), ("sales_order", 120, 6, 0, None),
        ("ticket_custom_fields", 2, 3, 0, 0), ("tickets", 1, 15, 0, 0),
    ]
    labels = read_current(spark, str(tmp_path / "ticket_custom_fields"), S.TICKET_CUSTOM_FIELDS)
    assert rows(labels) == [(1, "new", "taken"), (2, None, None)]
    # Leads whose date no rule could read are loaded without one, and kept apart with what it said.
    leads = nightly.Load(None, S.LEADS, problem="problem")
    apart = read_current(spark, str(tmp_path / "leads"), leads.rejected_schema, "rejected")
    assert rows(apart, "name", "dt", "problem") == [("bo", None, "2020/31"), ("c", None, "soon")]
    whole = read_current(spark, str(tmp_path / "leads"), S.LEADS)
    assert whole.where("dt IS NULL").count() == 2


def test_a_failed_load_leaves_the_old_tables(spark, landed, read, tmp_path, rows):
    path = str(tmp_path)

    def load(frame):
        return nightly.load_warehouse(spark, path, {"labels": nightly.Load(frame, S.TICKET_CUSTOM_FIELDS, key="ticket_id")})

    good = spark.createDataFrame([(1, "a", "b"), (1, "a", "c")], S.TICKET_CUSTOM_FIELDS)
    assert rows(load(good)) == [("labels", 2, 3, 0, 1)]
    held = read_current(spark, f"{path}/labels", S.TICKET_CUSTOM_FIELDS)
    broken = spark.range(0, 100, 1, 4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("mid-write"))).otherwise(F.col("id")).cast("bigint").alias("ticket_id"),
        F.lit("x").alias("trang_thai_cham_soc"), F.lit("y").alias("trang_thai_tiep_nhan"),
    )
    with pytest.raises(Exception, match="mid-write"):
        load(broken)
    assert rows(read_current(spark, f"{path}/labels", S.TICKET_CUSTOM_FIELDS)) == rows(good)
    assert [p.name for p in (tmp_path / "labels").iterdir() if p.name.startswith("v")] == [held.inputFiles()[0].split("/")[-3]]
    # A reader that began before the next load still finds its version; the one before that is gone.
    load(good.limit(0))
    assert rows(held) == rows(good)
    assert read_current(spark, f"{path}/labels", S.TICKET_CUSTOM_FIELDS).count() == 0
    load(good.limit(1))
    assert len([p for p in (tmp_path / "labels").iterdir() if p.name.startswith("v")]) == 2


def test_stock_load(spark, read, tmp_path):
    jobs.stock_load(read, "2021-02-01", str(tmp_path / "stock"))
    back = spark.read.parquet(str(tmp_path / "stock"))
    # Invoices of every second day at one location, up to the day before yesterday.
    assert back.count() == 15
    assert back.agg({"item_count": "min"}).first()[0] == -15


def test_daily_stock_load_equals_the_whole_snapshot(spark, read, tmp_path, rows):
    """Runs on days that follow each other, one of them twice, and after a pause."""
    path = str(tmp_path / "carried")
    for as_of in ("2021-01-10", "2021-01-11", "2021-01-11", "2021-01-12", "2021-02-20"):
        jobs.daily_stock_load(spark, read, as_of, path)
        jobs.stock_load(read, as_of, str(tmp_path / "whole"))
        names = S.INVENTORY_VALUATION.names
        whole = rows(spark.read.schema(S.INVENTORY_VALUATION).parquet(str(tmp_path / "whole")).select(*names))
        assert rows(spark.read.schema(S.INVENTORY_VALUATION).parquet(f"{path}/days").select(*names)) == whole != []


def test_exports(spark, landed, read, tmp_path):
    assert jobs.sheet_exports(read, read, "gift", str(tmp_path)) == {"leads": 1, "posts": 2}
    assert jobs.training_export(spark, str(landed / "training.csv"), str(tmp_path / "training")) == 2
    back = spark.read.csv(str(tmp_path / "training"), header=True)
    assert sorted(r["trainer"] for r in back.collect()) == ["VN0001", "VN0002"]
    assert {(r["phone"], r["employee_code"], r["Khóa"]) for r in back.collect()} == {("'091", "VN0003", "x")}


def test_forecast_jobs(spark, read, tmp_path):
    state = str(tmp_path / "state")
    holdout = jobs.train_sales_forecast(read, state)
    assert holdout.groupBy("location_id").count().orderBy("location_id").collect() == [(7, 40), (8, 40)]
    latest = jobs.score_sales_forecast(spark, read, state).orderBy("location_id").collect()
    assert [r["location_id"] for r in latest] == [7, 8]
    assert latest[0]["prediction"] is not None


def test_forecast_jobs_per_series_leave_no_working_tables(spark, read, tmp_path):
    state, target, shared = str(tmp_path / "state"), str(tmp_path / "holdout"), Path(shared_folder(spark))
    before = set(shared.iterdir())
    jobs.train_series_forecasts(spark, read, state, target)
    assert set(shared.iterdir()) == before
    held = spark.read.parquet(current(spark, target))
    assert held.groupBy("location_id").count().orderBy("location_id").collect() == [(7, 40), (8, 40)]
    latest = jobs.score_series_forecasts(spark, read, state).orderBy("location_id").collect()
    assert [r["location_id"] for r in latest] == [7, 8]
    # All 40 days of the second location are held out, so it has no model.
    assert sales.daily_sales(jobs.read_ledger(read), series_keys=("location_id",)).where("location_id = 8").count() == 40
    assert [r["prediction"] is None for r in latest] == [False, True]


def test_default_rules_name_the_same_accounts_once():
    assert len(set(sales.REVENUE_ACCOUNTS)) == 12 and len(set(inventory.STOCK_ACCOUNTS)) == 5
