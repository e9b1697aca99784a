"""Overwrite loads, sheet exports and the load audit."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopfloor.schemas import conform
from shopfloor.sources.files import read_csv


def overwrite_table(df: DataFrame, path: str, schema: StructType) -> None:
    """Replace the table by the frame, cut to the target schema."""
    conform(df, schema).write.mode("overwrite").option("compression", "snappy").parquet(path)


def overwrite_by_day(df: DataFrame, path: str, schema: StructType, day: str) -> None:
    """Replace the whole table, one folder per day.

    Rows are first brought together by day, else each task would add a small
    file to each folder. ``rebalance`` lets adaptive execution cut a heavy day
    into several tasks and files and merge light days.
    """
    (
        conform(df, schema)
        .hint("rebalance", F.col(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("compression", "snappy")
        .partitionBy(day)
        .parquet(path)
    )


def export_sheet(df: DataFrame, path: str, max_lines: int) -> int:
    """Write CSV files with a header, each for a spreadsheet range of ``max_lines`` lines.

    Rows beyond one range go on in further files, so any number fits; ``rebalance``
    keeps few rows from being many files. Text comes through as it is: quotes
    doubled, spaces at either end kept. Returns the number of rows, counted by
    reading back.
    """
    df.hint("rebalance").write.mode("overwrite").option("maxRecordsPerFile", max_lines - 1).csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return read_csv(df.sparkSession, path).count()


def load_audit(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Rows and columns per committed table: ``(table, n_rows, n_cols)``.

    Counts come from reading back, which touches Parquet footers only and is
    not thrown off by tasks that ran twice during the load.
    """

    def one(name: str, path: str) -> DataFrame:
        df = spark.read.parquet(path)
        return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table"), "n_rows", F.lit(len(df.columns)).cast("int").alias("n_cols")
        )

    return reduce(DataFrame.unionAll, [one(name, path) for name, path in tables.items()])
