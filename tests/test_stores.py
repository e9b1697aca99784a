from __future__ import annotations

import pytest

from shopfloor import schemas as S
from shopfloor.operators import stores as ops
from shopfloor.plans.reports import store_report


@pytest.fixture(scope="module")
def stores(spark):
    return spark.createDataFrame(
        [("a", "M1"), ("a", "M1"), ("b", "M1"), ("b", "M2"), ("b", "gone"), ("c", "gone"), (None, "M2"),
         ("a", None), (None, "M3"), ("a", "M4")],
        S.STORE_LIST,
    )


@pytest.fixture(scope="module")
def malls(spark):
    return spark.createDataFrame(
        [("M1", "P1", "D1", 1, 1, 50_000), ("M2", "P1", "D2", 1, 0, 20_000), ("M3", "P2", None, 0, 1, 10_000),
         ("M4", None, "D1", 1, 1, 10_001), ("M5", "P3", "D3", 1, 1, None)],
        S.MALL_DIM,
    )


@pytest.fixture(scope="module")
def per_mall(stores, malls):
    return ops.stores_per_mall(stores, malls)


def test_join_keeps_all_stores(stores, malls):
    joined = ops.store_mall_join(stores, malls)
    assert joined.columns == ["Comp", "Location", "Province", "Districts", "Promotion", "Special", "Likes"]
    assert joined.count() == 10
    assert joined.where("Location IS NULL").count() == 3


@pytest.mark.parametrize(
    ("key", "expected"),
    [
        ("Comp", [("a", 3), ("b", 2), ("c", 0)]),
        ("Location", [("M1", 3), ("M2", 1), ("M4", 1), ("M3", 0)]),
        ("Province", [("P1", 4), ("P2", 0)]),
        ("Districts", [("D1", 4), ("D2", 1)]),
    ],
)
def test_store_counts(per_mall, key, expected):
    assert [tuple(r) for r in ops.stores_by(per_mall, key).collect()] == expected
    above = [tuple(r) for r in ops.stores_by(per_mall, key, min_above=1).collect()]
    assert above == [e for e in expected if e[1] > 1]


def test_mall_counts(per_mall):
    assert [tuple(r) for r in ops.malls_by(per_mall, "Province").collect()] == [("P1", 2), ("P2", 1)]
    assert [tuple(r) for r in ops.malls_by(per_mall, "Districts").collect()] == [("D1", 2), ("D2", 1)]


def test_rankings(per_mall, malls):
    assert [r[0] for r in ops.top_malls(per_mall, 2).collect()] == ["M1", "M2"]
    assert [r[0] for r in ops.likes_ranking(malls).collect()] == ["M1", "M2", "M4"]
    assert [r[0] for r in ops.top_likes(malls).collect()] == ["M1", "M4"]


def test_report_job(spark, stores, malls):
    report = store_report(stores, malls)
    assert {name: [tuple(r) for r in df.collect()] for name, df in report.items()} == {
        "stores_by_brand": [("a", 3), ("b", 2), ("c", 0)],
        "stores_by_mall": [("M1", 3)],
        "stores_by_province": [("P1", 4)],
        "stores_by_district": [("D1", 4)],
        "malls_by_province": [("P1", 2), ("P2", 1)],
        "malls_by_district": [("D1", 2), ("D2", 1)],
        "likes": [("M1", 50_000), ("M2", 20_000), ("M4", 10_001)],
    }
