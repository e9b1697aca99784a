"""Relational sources. Connection details come from the caller or the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


# Times arrive as the database shows them, without a zone.
_WALL_CLOCK = {"preferTimestampNTZ": "true"}


@dataclass(frozen=True)
class Split:
    """Range split of a numeric or date column into parallel reads."""

    column: str
    lower: str | int
    upper: str | int
    partitions: int


def jdbc_options(prefix: str, database: str | None = None) -> dict[str, str]:
    """Options from ``<PREFIX>_URL``, ``_USER``, ``_PASSWORD`` and ``_DRIVER``.

    ``database`` is put in place of ``{database}`` in the URL.
    """
    options = {}
    for name in ("url", "user", "password", "driver"):
        value = os.environ.get(f"{prefix}_{name}".upper())
        if value:
            options[name] = value
    if "url" not in options:
        raise ValueError(f"{prefix.upper()}_URL is not set")
    if "{database}" in options["url"]:
        if not database:
            raise ValueError("this source needs a database name")
        options["url"] = options["url"].replace("{database}", database)
    return options


def table_options(options: dict[str, str], table: str, split: Split | None, fetch: int) -> dict[str, str]:
    extra = {"dbtable": table, "fetchsize": str(fetch), **_WALL_CLOCK}
    if split:
        extra |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.partitions),
        }
    return options | extra


def read_jdbc_table(
    spark: SparkSession, options: dict[str, str], table: str, split: Split | None = None, fetch: int = 10_000
) -> DataFrame:
    """A table; large ones need ``split``, or one task reads everything.

    Filters, column choice and simple aggregates reach the database.
    """
    return spark.read.format("jdbc").options(**table_options(options, table, split, fetch)).load()


def read_jdbc_query(
    spark: SparkSession, options: dict[str, str], query: str, fetch: int = 10_000
) -> DataFrame:
    """The result of a query that the database runs. One task reads it, so keep it to reduced results."""
    extra = {"query": query, "fetchsize": str(fetch), **_WALL_CLOCK}
    return spark.read.format("jdbc").options(**options, **extra).load()
