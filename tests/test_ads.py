from __future__ import annotations

from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan_of
from shopfloor import schemas as S
from shopfloor.operators import ads
from shopfloor.sources import read_table
from shopfloor.operators.hotkeys import cuts, left_join_all, match_counts

D = date(2021, 3, 4)
BUY, REPLY = "offsite_conversion.fb_pixel_purchase", "onsite_conversion.messaging_first_reply"


def act(*pairs):
    return [{"value": {"action_type": kind, "value": value}} for kind, value in pairs]


def ad(ad_id, region, actions, values=None, spend=1.0):
    return (D, 1, "camp", 2, "set", ad_id, f"ad {ad_id}", region, 10, 1.0, 1.0, "sale", spend, actions, values)


@pytest.fixture(scope="module")
def insights(spark):
    return spark.createDataFrame(
        [
            ad(1, "R1", None, act((BUY, 100))),
            ad(2, "R1", [], []),
            ad(3, "R1", act(("like", 1), ("share", 2))),
            ad(4, "R1", act((BUY, 1), (BUY, 1), (BUY, 2), ("comment", 3)), act((BUY, 50), ("cart", 1))),
            ad(4, "R1", act(("comment", 3)), None, 2.0),
            ad(5, None, act((REPLY, 4)), act((BUY, 5))),
        ],
        S.ADS_INSIGHTS_REGION,
    )


@pytest.fixture(scope="module")
def rankings(spark):
    return spark.createDataFrame(
        [(D, 1, 2, 4, "a", "b", "c"), (D, 1, 2, 5, "d", "e", "f"), (D, 1, 2, 5, "g", "h", "i"), (D, 9, 9, 9, "x", "y", "z")],
        S.ADS_INSIGHTS,
    )


def test_tracked_actions(insights, rows):
    got = rows(ads.tracked_actions(insights, "actions", ads.ACTION_COUNTS), "ad_id", "region", *ads.ACTION_COUNTS)
    assert got == [
        (3, "R1", None, None, None),
        (4, "R1", None, None, 3), (4, "R1", 1, None, None), (4, "R1", 2, None, None),
        (5, None, None, 4, None),
    ]


def test_report_repeats_rows_per_combination(insights, rankings, rows):
    report = ads.ads_report(insights, rankings)
    sizes = Counter((r["ad_name"], r["spend"]) for r in report.collect())
    assert sizes == {
        ("ad 1", 1.0): 1, ("ad 2", 1.0): 1, ("ad 3", 1.0): 1,
        ("ad 4", 1.0): 3 * 2, ("ad 4", 2.0): 3 * 2,
        ("ad 5", 1.0): 2,  # two rankings; no region, so no actions
    }
    five = rows(report.where("ad_name = 'ad 5'"), "new_messaging_conversations", "quality_ranking")
    assert five == [(None, "f"), (None, "i")]


def test_cut_ads_give_the_same_report(insights, rankings, rows):
    plain = ads.ads_report(insights, rankings, partitions=1)
    for partitions in (8, 1000, 100_000):
        assert rows(ads.ads_report(insights, rankings, partitions)) == rows(plain)


def test_cut_report_on_whole_table(spark, data):
    from shopfloor.catalog import adapters as A
    from shopfloor.catalog.queries import _rankings

    base, ranked = A.ADS.frame(spark, data), _rankings(spark, data)
    plain = ads.ads_report(base, ranked, partitions=1)
    cut = ads.ads_report(base, ranked, partitions=200_000)
    assert plain.exceptAll(cut).count() == 0 == cut.exceptAll(plain).count()


def test_row_formula_on_whole_table(spark, data):
    """Each base row repeats max(1, actions) x max(1, values) x max(1, rankings) times."""
    from shopfloor.catalog import adapters as A
    from shopfloor.catalog.queries import _rankings

    base, ranked = A.ADS.frame(spark, data), _rankings(spark, data)

    def matches(df, keys, name):
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))

    counts = matches(ads.tracked_actions(base, "actions", ads.ACTION_COUNTS), ads.REGION_KEY, "a")
    values = matches(ads.tracked_actions(base, "action_values", ads.ACTION_VALUES), ads.REGION_KEY, "v")
    ranks = matches(ranked, ads.AD_KEY, "r")
    expected = (
        base.join(counts, list(ads.REGION_KEY), "left")
        .join(values, list(ads.REGION_KEY), "left")
        .join(ranks, list(ads.AD_KEY), "left")
        .agg(F.sum(F.expr("coalesce(a, 1) * coalesce(v, 1) * coalesce(r, 1)")))
        .first()[0]
    )
    assert ads.ads_report(base, ranked).count() == expected > base.count()


def test_equal_rows_are_split_by_the_sort(spark):
    copies = spark.range(0, 20_000, 1, 8).select(
        F.lit(D).alias("date_start"), *[F.lit("x").alias(c) for c in ("campaign_name", "adset_name", "ad_name", "region")]
    )
    ordered = ads.order_report(copies)
    assert ordered.columns == copies.columns
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        sizes = [r["n"] for r in ordered.select(F.spark_partition_id().alias("p")).groupBy("p").agg(F.count("p").alias("n")).collect()]
    finally:
        spark.conf.set(key, "true")
    assert len(sizes) > 1 and sum(sizes) == 20_000


def test_order(insights, rankings):
    later = insights.withColumn("date_start", F.lit(date(2021, 3, 5)))
    got = ads.order_report(ads.ads_report(insights.union(later), rankings)).collect()
    keys = [(-r["date_start"].toordinal(), r["campaign_name"], r["ad_name"]) for r in got]
    assert keys == sorted(keys)


def test_nothing_runs_while_the_plan_is_made(spark, insights, rankings):
    status, group = spark.sparkContext.statusTracker(), "ads-plan"
    spark.sparkContext.setJobGroup(group, "plan only")
    try:
        ads.order_report(ads.ads_report(insights, rankings))
        assert not status.getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def _made_per_task(df):
    """Rows that come out of each task of the joins."""
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]


@pytest.fixture
def fixed_partitions(spark):
    """No merging of small partitions, no broadcast: the join's own partitioning shows."""
    wanted = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_few_rows_with_a_huge_product_spread(spark, fixed_partitions):
    """Three base rows and two sides of 300 on one key, beside 1,000 plain keys."""
    base = spark.createDataFrame([(7, i) for i in range(3)] + [(100 + i, 0) for i in range(1000)], "k bigint, b int")
    one = spark.range(300).select(F.lit(7).cast("bigint").alias("k"), F.col("id").alias("x"))
    two = spark.range(300).select(F.lit(7).cast("bigint").alias("k"), F.col("id").alias("y"))
    joined = left_join_all(base, [one, two], ["k"], partitions=16)
    sizes = _made_per_task(joined.where("k = 7"))
    assert sum(sizes) == 3 * 300 * 300 and joined.count() == sum(sizes) + 1000
    assert joined.distinct().count() == joined.count()
    assert len(sizes) > 10 and max(sizes) < sum(sizes) / 5


def test_cuts_follow_the_rows_that_come_out(spark):
    counts = spark.createDataFrame(
        [(1, 1, 0, 0), (2, 100_000, 0, 3), (3, 2, 500, 600), (4, 50, 1, 1)], "k bigint, n0 bigint, n1 bigint, n2 bigint"
    )
    hot = {r["k"]: tuple(r)[1:] for r in cuts(counts, ["k"], 2, 16).collect()}
    # 900,051 rows over 16 tasks: about 56,253 each, a quarter of that to a cell.
    assert hot == {2: (21, 1, 1), 3: (2, 21, 1)}
    assert cuts(counts.limit(0), ["k"], 2, 16).count() == 0


def test_rows_without_a_key_spread_and_match_nothing(spark, fixed_partitions):
    base = spark.range(0, 3000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    side = spark.createDataFrame([(0, "x"), (0, "y"), (3, "z"), (None, "n"), (1, "o")], "k bigint, w string")
    joined = left_join_all(base, [side, side.withColumnRenamed("w", "u")], ["k"], partitions=16)
    plain = base.join(side, "k", "left").join(side.withColumnRenamed("w", "u"), "k", "left")
    assert joined.columns == plain.columns
    assert joined.exceptAll(plain).count() == 0 == plain.exceptAll(joined).count()
    sizes = _made_per_task(joined.where("k IS NULL"))
    assert sum(sizes) == 2000 and len(sizes) > 4 and max(sizes) < 800


def test_hot_keys_of_every_shape_give_the_plain_join(spark):
    import random

    rng = random.Random(1)
    base = spark.createDataFrame([(rng.choice([1, 1, 1, 2, 3, None]), i) for i in range(300)], "k bigint, b int")
    sides = [
        spark.createDataFrame([(rng.choice(ks), i) for i in range(n)], f"k bigint, {name} int")
        for ks, n, name in (([1, 2], 5, "x"), ([2, 4], 40, "y"), ([3, 3, 1, None], 30, "z"))
    ]
    plain = base
    for side in sides:
        plain = plain.join(side, "k", "left")
    for partitions in (1, 7, 500):
        joined = left_join_all(base, sides, ["k"], partitions=partitions)
        assert joined.exceptAll(plain).count() == 0 == plain.exceptAll(joined).count()
    assert match_counts(base, sides, ["k"]).where("k IS NULL").count() == 0


def test_wide_totals(insights, rows):
    names = [*ads.ACTION_COUNTS, *ads.ACTION_VALUES]
    wide = ads.ads_wide(insights)
    assert rows(wide, "ad_id", "spend", *names) == [
        (1, 1.0, None, None, None, 100), (2, 1.0, None, None, None, None), (3, 1.0, None, None, None, None),
        (4, 1.0, 4, None, 3, 50), (4, 2.0, None, None, 3, None), (5, 1.0, None, 4, None, 5),
    ]
    plan = plan_of(wide)
    assert "Exchange" not in plan and "Generate" not in plan and "Join" not in plan


def test_files_with_more_nested_fields_are_read_to_the_contract(spark, insights, tmp_path, rows):
    path = str(tmp_path / "ads")
    more = F.transform("actions", lambda a: F.struct(F.lit("x").alias("kind"), a["value"].withField("window", F.lit("28d")).alias("value")))
    insights.withColumn("actions", more).withColumn("extra", F.lit(1)).write.parquet(path)
    read = ads.tracked_actions(read_table(spark, path, S.ADS_INSIGHTS_REGION), "actions", ads.ACTION_COUNTS)
    assert rows(read) == rows(ads.tracked_actions(insights, "actions", ads.ACTION_COUNTS))
    length = "spark.sql.maxMetadataStringLength"
    spark.conf.set(length, "2000")
    try:
        schema = plan_of(ads.tracked_actions(read_table(spark, path, S.ADS_INSIGHTS_REGION), "actions", ads.ACTION_COUNTS))
    finally:
        spark.conf.unset(length)
    schema = schema.split("ReadSchema: ")[1].split("\n")[0]
    assert "array<struct<value:struct<action_type:string,value:bigint>>>" in schema
    assert not any(name in schema for name in ("window", "kind", "extra", "spend", "action_values"))


def test_geo_cost(spark, rows):
    row = (D, "c", "g", 1, 10, 1, 2_000_000, 0.5, 0.25)
    usd = spark.createDataFrame([row], S.GEO_PERFORMANCE)
    local = spark.createDataFrame([(*row[:3], 8, *row[4:6], 23_395_000_000, *row[7:])], S.GEO_PERFORMANCE)
    places = spark.createDataFrame([(1, "Here")], S.LOCATION_NAMES)
    got = ads.geo_cost([ads.AdAccount("usd", usd), ads.AdAccount("local", local, ads.LOCAL_RATE)], places)
    assert rows(got, "account", "cost", "region") == [("local", 1.0, None), ("usd", 2.0, "Here")]
