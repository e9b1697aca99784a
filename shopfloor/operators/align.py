"""Aligning frames by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def unite(*sources: DataFrame) -> DataFrame:
    """All rows of all sources, aligned by column name; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
