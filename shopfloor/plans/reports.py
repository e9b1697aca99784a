"""Report jobs that derive several results from one base."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shopfloor.operators import stores as ops
from shopfloor.session import materialize


def store_report(stores: DataFrame, malls: DataFrame) -> dict[str, DataFrame]:
    """All tables of the competitor-store report.

    The counts share one pass over the stores: the joined counts per brand and
    mall are written once and read by each.
    """
    per_mall = materialize(ops.stores_per_mall(stores, malls), "stores-per-mall")
    return {
        "stores_by_brand": ops.stores_by(per_mall, "Comp"),
        "stores_by_mall": ops.stores_by(per_mall, "Location", min_above=1),
        "stores_by_province": ops.stores_by(per_mall, "Province", min_above=1),
        "stores_by_district": ops.stores_by(per_mall, "Districts", min_above=1),
        "malls_by_province": ops.malls_by(per_mall, "Province"),
        "malls_by_district": ops.malls_by(per_mall, "Districts"),
        "likes": ops.likes_ranking(malls),
    }
