"""Left joins that stay balanced however much a few keys multiply.

Adaptive execution splits skewed partitions of a single join, but not where
several joins follow each other on the same keys without a shuffle between them,
and not by the rows that come out. Here the rows that come out of each key are
worked out first, inside the same query: a key with more than its share of them is
cut into cells, each with a part of its rows on either side.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Part of an average task's rows that one cell of a key should make.
SHARE = 0.25

_CELL = "_cell"


def _known(keys: Sequence[str]) -> str:
    return " AND ".join(f"`{k}` IS NOT NULL" for k in keys)


def _product(factors: Sequence[str]) -> str:
    return " * ".join(factors) or "1L"


def match_counts(base: DataFrame, sides: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Per key of ``base`` its rows there and in each side: ``n0``, ``n1``, and so on.

    One aggregate over the key columns of all of them, combined inside the tasks.
    """
    tagged = [df.where(_known(keys)).select(*keys, F.lit(i).alias("_side")) for i, df in enumerate([base, *sides])]
    numbers = [F.expr(f"count_if(_side = {i}) AS n{i}") for i in range(len(tagged))]
    return reduce(DataFrame.unionAll, tagged).groupBy(*keys).agg(*numbers).where("n0 > 0")


def cuts(counts: DataFrame, keys: Sequence[str], sides: int, partitions: int) -> DataFrame:
    """Hot keys and the number of parts ``s0``, ``s1``, … their rows on each side are cut into.

    Looked at are the ``partitions / SHARE`` keys that make the most rows: any
    other makes less than ``SHARE`` of what an average task makes, whatever the
    data. So the table is small enough to go to every task, and no key that matters
    is left out. The base is cut first, then the sides in turn, as far as their
    rows reach.
    """
    most = math.ceil(partitions / SHARE)
    rows = ["n0", *[f"greatest(n{i}, 1L)" for i in range(1, sides + 1)]]
    made = _product([f"CAST({r} AS DOUBLE)" for r in rows])
    parts, left = [], "_cells"
    for i, n in enumerate(rows):
        part = f"least({n}, {left})"
        parts.append(f"{part} AS s{i}")
        left = f"ceil({left} / {part})"
    # The window sees at most ``most`` rows, which are in one place already.
    return (
        counts.selectExpr("*", f"{made} AS _made")
        .orderBy(F.desc("_made"), *keys)
        .limit(most)
        .selectExpr("*", f"floor(_made / (sum(_made) OVER (PARTITION BY 0) / {most})) AS _cells")
        .where("_cells > 1")
        .selectExpr(*[f"`{k}`" for k in keys], *parts)
    )


def _dealt(df: DataFrame, hot: DataFrame, keys: Sequence[str], at: int, sides: int, keyless: int = 1) -> DataFrame:
    """Rows of side ``at`` in their cells: one own part, each part of the others.

    The part comes from the row's content and its input partition, so a retried
    task repeats it, and equal copies from different partitions still spread. Rows
    without a key, which match nothing, are spread over ``keyless`` parts.
    """
    columns = [f"`{c}`" for c in df.columns]
    parts = [f"coalesce(s{i}, 1L)" for i in range(sides + 1)]
    if keyless > 1:
        parts[at] = f"if({_known(keys)}, {parts[at]}, {keyless}L)"
    others = _product([p for i, p in enumerate(parts) if i != at])
    # The base keeps the parts: they tell which empty matches are none.
    more = [f"_met{at}"] if at else [f"s{i}" for i in range(1, sides + 1)]
    return (
        df.selectExpr("*", f"xxhash64(spark_partition_id(), {', '.join(columns)}) AS _own", *([f"true AS _met{at}"] if at else []))
        .join(F.broadcast(hot), list(keys), "left")
        .selectExpr(
            *columns, *more, f"pmod(_own, {parts[at]}) AS _own", f"{_product(parts[:at])} AS _below", f"{parts[at]} AS _parts",
            f"explode(sequence(0L, {others} - 1)) AS _other",
        )
        .selectExpr(*columns, *more, f"_other % _below + _below * (_own + _parts * (_other div _below)) AS {_CELL}")
    )


def left_join_all(
    base: DataFrame, sides: Sequence[DataFrame], keys: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """``base`` LEFT JOIN each of ``sides`` on ``keys``, rows repeated once per combination.

    Nothing runs while the plan is made. All joins share one partitioning, by key
    and cell. Where a side is cut, a base row meets no row of a cell it has no match
    in; its matches are in other cells then, so that empty row is dropped. Any
    cutting gives the same rows. ``partitions`` is the number of tasks to balance
    for, that of the session's shuffles if unset.
    """
    spark, n = base.sparkSession, len(sides)
    if partitions is None:
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    hot = cuts(match_counts(base, sides, keys), keys, n, partitions)
    out = _dealt(base, hot, keys, 0, n, partitions)
    for i, side in enumerate(sides, 1):
        out = out.join(_dealt(side.where(_known(keys)), hot, keys, i, n), [*keys, _CELL], "left")
    whole = " AND ".join(f"(coalesce(s{i}, 1L) = 1 OR _met{i})" for i in range(1, n + 1))
    columns = dict.fromkeys([*base.columns, *[c for side in sides for c in side.columns]])
    return out.where(whole).select(*columns)
