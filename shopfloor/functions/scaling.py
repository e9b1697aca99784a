"""Min-max scaling by parameter columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _span(low: Column, high: Column) -> Column:
    # A constant series scales with 1, so that it becomes 0.
    return F.when(high == low, F.lit(1.0)).otherwise(high - low)


def scale(value: Column, low: Column, high: Column) -> Column:
    return (value - low) / _span(low, high)


def unscale(scaled: Column, low: Column, high: Column) -> Column:
    return scaled * _span(low, high) + low
