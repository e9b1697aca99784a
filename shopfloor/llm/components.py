"""Connected components of a graph that no single task could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.session import materialize


def _state(links: DataFrame) -> tuple:
    """Number of links and an order-free checksum of them."""
    row = links.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")).alias("sum"),
    ).first()
    return row["n"], row["sum"]


def _nearest(links: DataFrame, node: str, other: str) -> DataFrame:
    return links.groupBy(F.col(node).alias("node")).agg(F.min(other).alias("nearest"))


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node around it."""
    both = links.select(F.col("high").alias("node"), F.col("low").alias("other")).unionAll(
        links.select(F.col("low").alias("node"), F.col("high").alias("other"))
    )
    nearest = _nearest(both, "node", "other")
    return (
        both.where("other > node")
        .join(nearest, "node")
        .select(F.col("other").alias("high"), F.least("node", "nearest").alias("low"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    nearest = _nearest(links, "high", "low")
    moved = (
        links.join(nearest, links["high"] == nearest["node"])
        .where("low > nearest")
        .select(F.col("low").alias("high"), F.col("nearest").alias("low"))
    )
    return moved.unionAll(nearest.select(F.col("node").alias("high"), F.col("nearest").alias("low"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """Columns ``node``, ``component`` (smallest node reachable) of all linked nodes.

    ``links`` has two columns of one orderable type; their names do not matter.
    Alternating star contraction: in every round each node looks at the minimum
    among its neighbours, taken by an aggregate, so no group is gathered and the
    links never grow in number. Each round is a written table, from which a lost
    executor's work restarts. Null ends and links of a node to itself mean
    nothing; without links the result is empty.
    """
    a, b = links.columns
    links = links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("high") != F.col("low"))
    )
    current = materialize(links.distinct(), "links")
    state = _state(current)
    while state[0]:
        current = materialize(_small_star(_large_star(current)), "links")
        before, state = state, _state(current)
        if state == before:
            break
    roots = current.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return current.select(F.col("high").alias("node"), F.col("low").alias("component")).unionAll(roots)
