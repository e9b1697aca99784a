"""Competitor stores in malls: join, counts, flags and rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def store_mall_join(stores: DataFrame, malls: DataFrame) -> DataFrame:
    """Each store with its mall's attributes; the store's own mall name is dropped."""
    return stores.join(malls, stores["Mall"] == malls["Location"], "left").drop("Mall")


def stores_per_mall(stores: DataFrame, malls: DataFrame) -> DataFrame:
    """Number of stores per brand and mall, joined to the mall: the base of all counts.

    Counting first means the join sees each brand-mall pair once, however many
    stores it has.
    """
    counted = stores.groupBy("Comp", "Mall").agg(F.count(F.lit(1)).alias("n"))
    return store_mall_join(counted, malls)


def _report(grouped: DataFrame, key: str, measure: str, min_above: int | None) -> DataFrame:
    if min_above is not None:
        grouped = grouped.where(F.col(measure) > min_above)
    return grouped.orderBy(F.desc(measure), key)


def stores_by(per_mall: DataFrame, key: str, *, min_above: int | None = None) -> DataFrame:
    """Stores per ``Comp``, ``Location``, ``Province`` or ``Districts``, largest first.

    Null keys form no group. Per brand only stores in a listed mall count; per
    place only stores with a brand. ``min_above`` keeps larger counts only.
    """
    counted = F.col("Location") if key == "Comp" else F.col("Comp")
    number = F.sum(F.when(counted.isNotNull(), F.col("n")).otherwise(0))
    grouped = per_mall.where(F.col(key).isNotNull()).groupBy(key).agg(number.alias("stores"))
    return _report(grouped, key, "stores", min_above)


def malls_by(per_mall: DataFrame, key: str, *, min_above: int | None = None) -> DataFrame:
    """Distinct malls that hold a store, per ``Province`` or ``Districts``."""
    number = F.count_distinct("Location")
    grouped = per_mall.where(F.col(key).isNotNull()).groupBy(key).agg(number.alias("malls"))
    return _report(grouped, key, "malls", min_above)


def allows_promotion(df: DataFrame) -> DataFrame:
    """Rows whose mall allows promotions and runs special programmes."""
    return df.where((F.col("Promotion") == 1) & (F.col("Special") == 1))


def top_malls(per_mall: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` malls with most stores; ties go to the smaller name."""
    return stores_by(per_mall, "Location").limit(k)


def likes_ranking(malls: DataFrame, above: float = 1e4) -> DataFrame:
    """Malls above a number of likes, most liked first."""
    return (
        malls.where(F.col("Likes") > above)
        .select("Location", "Likes")
        .orderBy(F.desc("Likes"), "Location")
    )


def top_likes(malls: DataFrame, k: int = 5, above: float = 1e4) -> DataFrame:
    """The ``k`` most liked malls among those with promotions and programmes."""
    return likes_ranking(allows_promotion(malls), above).limit(k)
