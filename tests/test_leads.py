from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan_of
from shopfloor import schemas as S
from shopfloor.functions import dates
from shopfloor.operators.leads import hotline_calls, lead_dedup, lead_union, post_meta
from shopfloor.plans.loads import LeadFiles, lead_funnel

T = datetime(2021, 3, 4, 5, 6)
D = T.date()


@pytest.fixture(scope="module")
def funnel(spark):
    calls = spark.createDataFrame(
        [
            (T, "912345678", "Connected", "1900"),
            (T, "912345678", "Connected", "1800"),
            (T, "912345678", "Missed", "1900"),
            (T, "912345678", None, "1900"),
        ],
        S.HOTLINE_CALLS,
    )
    return {
        "calls": hotline_calls(calls, "1900"),
        "messages": spark.createDataFrame([("an", "x", "4/3/2021"), ("binh", "84912345678", "bad")], S.MESSAGES_CSV),
        "ad_forms": spark.createDataFrame([(T, "chi", "0912345678", "c@x")], S.AD_LEADS_CSV),
        "partner_forms": spark.createDataFrame([(T, "d", "1", "d@x", "g1")], S.AD_LEADS_GCLID_CSV),
        "second_partner_forms": spark.createDataFrame([(T, "e", "1", "e@x", "g2")], S.AD_LEADS_GCLID_CSV),
        "shop_forms": spark.createDataFrame(
            [("2020-01-01T23:30:00+07:00", "912345678", "f@x", "g3", "cpc", "web")], S.SHOP_FORM_CSV
        ),
        "desk_calls": spark.createDataFrame(
            [
                (1, "g", "912345678", "g@x", "g4", "camp", "page", T, None),
                (2, "g", "912345678", "g@x", "g4", "camp", "page", T, "0"),
                (3, "g", "912345678", "g@x", "g4", "camp", "page", T, "12"),
            ],
            S.SALES_CALLS,
        ),
    }


def test_union(funnel, rows):
    united = lead_union(**funnel)
    assert united.schema.simpleString() == S.LEADS.simpleString()
    got = rows(united, "channel", "source", "name", "phone", "date", "gclid", "status", "shopify_order_id")
    ads, form = "LP Digital - FB Ads", "LP Digital - Shopify Form"
    phone = "0912345678"
    expected = [
        ("Hotline", None, None, phone, D, None, "Connected", None),
        ("Leads", ads, "chi", phone, D, None, None, None),
        ("Leads", ads, "e", None, D, "g2", None, None),
        ("Leads", ads + " 3rd1", "d", None, D, "g1", None, None),
        ("Leads", form, None, phone, date(2020, 1, 1), "g3", None, None),
        ("Leads", "LP EC", "g", phone, D, "g4", None, None),
        ("Leads", "LP EC", "g", phone, D, "g4", None, "0"),
        ("Leads", "Shopify Order", "g", phone, D, "g4", None, "12"),
        ("Messages", None, "an", None, D, None, None, None),
        ("Messages", None, "binh", phone, None, None, None, None),
    ]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_union_moves_no_rows(funnel):
    plan = plan_of(lead_union(**funnel))
    assert "Exchange" not in plan and "Python" not in plan


def test_union_row_count(spark, data):
    from shopfloor.catalog import adapters as A
    from shopfloor.catalog.queries import QUERIES

    parts = [A.MESSAGES, A.AD_FORMS, A.PARTNER_FORMS, A.SECOND_PARTNER_FORMS, A.SHOP_FORMS, A.SALES_CALLS]
    expected = QUERIES["hotline_calls"](spark, data).count() + sum(p.frame(spark, data).count() for p in parts)
    assert QUERIES["lead_union"](spark, data).count() == expected


def test_dedup_keeps_the_lowest_id(spark, rows):
    early, late = datetime(2021, 3, 4, 1), datetime(2021, 3, 4, 23)
    calls = spark.createDataFrame(
        [
            (5, "a", "1", "late@x", None, "c", None, late, None),
            (3, "a", "1", "first@x", None, "c", None, late, None),
            (4, "a", "1", "early@x", None, "c", None, early, None),
            (6, "a", "1", None, "g", "c", None, early, None),
            (7, "a", "1", None, None, "c", None, datetime(2021, 3, 5), None),
            (8, None, None, None, None, None, None, None, None),
            (9, None, None, None, None, None, None, None, None),
        ],
        S.SALES_CALLS,
    )
    assert rows(lead_dedup(calls), "salescall_id", "customer_email", "created_at") == [
        (3, "first@x", "2021-03-04"), (6, None, "2021-03-04"), (7, None, "2021-03-05"), (8, None, None),
    ]


def test_dedup_combines_before_the_shuffle(spark):
    plan = plan_of(lead_dedup(spark.createDataFrame([], S.SALES_CALLS)))
    assert "Window" not in plan
    assert plan.index("Exchange") < plan.index("partial_min")


def test_post_meta(spark, rows):
    posts = spark.createDataFrame(
        [(1, "091", "gift", T), (2, "092", "gift", T), (3, "093", "page", T), (None, "094", "gift", None)], S.POSTS
    )
    meta = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (3, "c"), (9, "d"), (None, "e"), (2, None)], S.POST_META)
    day = "2021-03-04"
    assert rows(post_meta(posts, meta, "gift")) == [
        (None, "094", None, None), (1, "091", "a", day), (1, "091", "b", day), (1, "091", "b", day),
        (2, "092", None, day),
    ]


def test_post_meta_sorts_no_values(spark, rows):
    """Where posts are too many to broadcast, they are hashed."""
    posts = spark.createDataFrame([(i, f"09{i % 7}", "gift" if i % 5 else "page", T) for i in range(50)], S.POSTS)
    meta = spark.createDataFrame([(i % 40, f"v{i}") for i in range(200)], S.POST_META)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    wanted = rows(post_meta(posts, meta, "gift"))
    spark.conf.set(key, "-1")
    try:
        found = post_meta(posts, meta, "gift")
        plan = plan_of(found)
        assert "SortMergeJoin" not in plan and plan.count("ShuffledHashJoin") == 3
        assert rows(found) == wanted and len(wanted) == 168
    finally:
        spark.conf.set(key, before)


def test_dates(spark):
    values = ["31/12/2020", "1/2/2020", "2020-13-01", "31/2/2020", None]
    df = spark.createDataFrame([(v,) for v in values], "d string")
    got = [r[0] for r in df.select(dates.parse_day_first(F.col("d")).cast("date")).collect()]
    assert got == [date(2020, 12, 31), date(2020, 2, 1), None, None, None]


def test_month_first_dates(spark):
    values = ["2020-05-04 10:20:30", "5/4/2020", "5/14/2020 9:05", "14/5/2020", "x", None]
    df = spark.createDataFrame([(v,) for v in values], "d string")
    got = [r[0] for r in df.select(dates.parse_month_first(F.col("d"))).collect()]
    assert got == [
        datetime(2020, 5, 4, 10, 20, 30), datetime(2020, 5, 4), datetime(2020, 5, 14, 9, 5), None, None, None,
    ]


def test_funnel_from_landed_files(spark, tmp_path, rows):
    bodies = {
        "messages": "Tên,Note,Phone(raw),Date(raw)\nan,hi,0912345678,31/12/2020\n",
        "ad_forms": "Date,Name,Phone,Email,Extra\n2021-03-04 05:06:00,binh,912345678,b@x,1\n",
        "partner_forms": "Date,Name,Phone,Email,Gclid\n3/4/2021,chi,84912345678,c@x,g1\n",
        "second_partner_forms": "Gclid,Date,Name,Phone,Email\ng2,3/4/2021,dung,,d@x\n",
        "shop_forms": "First Subscribed On,Phone Number,Email,gclid,initial_utm_medium,initial_utm_source\n"
        "2021-03-04T01:00:00+07:00,0912345678,e@x,,cpc,web\n",
    }
    for name, body in bodies.items():
        (tmp_path / f"{name}.csv").write_text(body)
    files = LeadFiles(**{name: str(tmp_path / f"{name}.csv") for name in bodies})
    calls = spark.createDataFrame([(T, "0912345678", "C", "1900")], S.HOTLINE_CALLS)
    desk = spark.createDataFrame([(1, "f", "0912345678", None, None, None, None, T, "5")], S.SALES_CALLS)
    got = rows(lead_funnel(spark, files, calls, desk, "1900"), "channel", "source", "phone", "dt", "gclid")
    phone, ads = "0912345678", "LP Digital - FB Ads"
    expected = [
        ("Hotline", None, phone, T, None),
        ("Messages", None, phone, datetime(2020, 12, 31), None),
        ("Leads", ads, phone, T, None),
        ("Leads", ads + " 3rd1", phone, datetime(2021, 3, 4), "g1"),
        ("Leads", ads, None, datetime(2021, 3, 4), "g2"),
        ("Leads", "LP Digital - Shopify Form", phone, datetime(2021, 3, 3, 18), None),
        ("Leads", "Shopify Order", phone, T, None),
    ]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_zoned_time_becomes_utc(spark):
    df = spark.createDataFrame([("2020-01-01T23:30:00+07:00",), ("2020-01-01T23:30:00Z",), ("x",)], "t string")
    got = [r[0] for r in df.select(dates.parse_zoned_as_utc(F.col("t"))).collect()]
    assert got == [datetime(2020, 1, 1, 16, 30), datetime(2020, 1, 1, 23, 30), None]
