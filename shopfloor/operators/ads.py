"""Ad performance: nested action lists per ad and region, and cost by place."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.operators.align import unite
from shopfloor.operators.hotkeys import left_join_all

AD_KEY = ("date_start", "campaign_id", "adset_id", "ad_id")
REGION_KEY = (*AD_KEY, "region")

# Output column -> tracked action type.
ACTION_COUNTS = {
    "offline_conversion_purchase": "offsite_conversion.fb_pixel_purchase",
    "new_messaging_conversations": "onsite_conversion.messaging_first_reply",
    "comments": "comment",
}
ACTION_VALUES = {
    "offline_conversion_purchase_value": "offsite_conversion.fb_pixel_purchase",
}

_REPORT = (
    "date_start", "campaign_name", "adset_name", "ad_name", "region",
    "reach", "cpm", "frequency", "objective", "spend",
)
_RANKINGS = ("conversion_rate_ranking", "engagement_rate_ranking", "quality_ranking")


def tracked_actions(ads: DataFrame, actions: str, tracked: Mapping[str, str]) -> DataFrame:
    """Distinct key plus one column per tracked type, from the array ``actions``.

    Each array element gives a row with its value under the matching type and
    null elsewhere, so all untracked elements of a key become one all-null row.
    Rows with a null or empty array give none. Equal elements are removed
    inside each array first, which shrinks what the distinct has to move.
    """

    def picked(action: Column) -> Column:
        entry = action["value"]
        return F.struct(
            *[F.when(entry["action_type"] == kind, entry["value"]).alias(name) for name, kind in tracked.items()]
        )

    elements = F.array_distinct(F.transform(F.col(actions), picked))
    return ads.select(*REGION_KEY, F.explode(elements).alias("picked")).select(*REGION_KEY, "picked.*").distinct()


def ads_report(ads: DataFrame, rankings: DataFrame, partitions: int | None = None) -> DataFrame:
    """Every ad-region row with its actions, action values and rankings.

    All three are left joins on the ad key, so a row repeats once per
    combination of matching rows; that is the meaning of the report. Rows
    without a region match no actions. The rankings, whose key differs, come
    first: later the shuffle for them would have to move the repeated rows. Keys
    whose rows multiply are cut into parts (``partitions``: the number of tasks to
    balance for).
    """
    base = ads.select(*dict.fromkeys((*REGION_KEY, *_REPORT)))
    ranked = base.join(rankings.select(*AD_KEY, *_RANKINGS), list(AD_KEY), "left")
    counts = tracked_actions(ads, "actions", ACTION_COUNTS)
    values = tracked_actions(ads, "action_values", ACTION_VALUES)
    joined = left_join_all(ranked, [counts, values], REGION_KEY, partitions)
    return joined.select(*_REPORT, *ACTION_COUNTS, *ACTION_VALUES, *_RANKINGS)


def ads_wide(ads: DataFrame) -> DataFrame:
    """Every ad-region row once, with the total of each tracked action and action value.

    Another result than ``ads_report``: nothing is exploded or joined, so rows
    neither repeat nor move. A type that a row does not have is null; equal
    elements of one row all count, elements without a value do not.
    """

    def total(actions: str, kind: str) -> Column:
        found = F.filter(actions, lambda a: (a["value"]["action_type"] == kind) & a["value"]["value"].isNotNull())
        nothing = F.lit(None).cast("bigint")
        return F.aggregate(found, nothing, lambda sum_, a: F.coalesce(sum_, F.lit(0)) + a["value"]["value"])

    totals = [
        total(actions, kind).alias(name)
        for actions, tracked in (("actions", ACTION_COUNTS), ("action_values", ACTION_VALUES))
        for name, kind in tracked.items()
    ]
    return ads.select(*AD_KEY, *_REPORT[1:], *totals)


def order_report(report: DataFrame) -> DataFrame:
    """Newest day first, then names and region.

    The remaining columns break ties, so equal sort keys do not have to share
    one range partition; copies equal in every column split by where they were
    made.
    """
    leading = ("date_start", "campaign_name", "adset_name", "ad_name", "region")
    rest = [c for c in report.columns if c not in leading]
    return report.orderBy(F.desc("date_start"), *leading[1:], *rest, F.spark_partition_id())


@dataclass(frozen=True)
class AdAccount:
    """One account's report; ``rate`` is its currency per unit of report currency."""

    name: str
    performance: DataFrame
    rate: float = 1.0


# Costs arrive in millionths; rate of the local-currency account.
MICROS = 1_000_000
LOCAL_RATE = 23395.0


def geo_cost(accounts: Sequence[AdAccount], locations: DataFrame) -> DataFrame:
    """All accounts with cost in one currency and the place name (null if unknown)."""
    parts = [
        a.performance.select(
            F.lit(a.name).alias("account"),
            "day", "campaign", "adgroup", "region", "impressions", "clicks",
            (F.col("cost").cast("double") / F.lit(MICROS * float(a.rate))).alias("cost"),
            "allconv", "allconvvalue",
        )
        for a in accounts
    ]
    names = locations.select(F.col("Criteria_ID").alias("region"), F.col("Name").alias("region_name"))
    return (
        unite(*parts)
        .join(names, "region", "left")
        .select(
            "account", "day", "campaign", "adgroup", "impressions", "clicks", "cost",
            "allconv", "allconvvalue", F.col("region_name").alias("region"),
        )
    )
