"""Readers for landed files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet data set, nested records included."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_csv(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, quoted_breaks: bool = True
) -> DataFrame:
    """CSV with a header line, all or some of its columns, every one as text.

    Parsing dates and numbers is left to the caller, so a phone keeps its
    leading 0 and no pass over the data is spent on guessing types. Files whose
    header differs from the first one are an error, not silently shifted. A quoted
    cell may hold line breaks and doubled quotes; a backslash is a letter like any
    other; an empty cell is null, quoted or not. A file is therefore read by one task,
    and large inputs come in files. Where no cell holds a line break, ``quoted_breaks=False``
    lets Spark cut a file at its lines and many tasks read it.
    """
    df = spark.read.option("enforceSchema", False).csv(
        path, header=True, inferSchema=False, multiLine=quoted_breaks, escape='"'
    )
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


def read_json_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One nested JSON document per file, or one array of them; see ``read_json_lines``."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One nested JSON document per line."""
    return spark.read.schema(schema).json(path)


def read_sheets(spark: SparkSession, folder: str, sheets: Sequence[str]) -> dict[str, DataFrame]:
    """A workbook landed as one CSV data set per sheet: ``<folder>/<sheet>``."""
    return {name: read_csv(spark, f"{folder}/{name}") for name in sheets}


def preview(df: DataFrame, rows: int = 5) -> tuple[DataFrame, list[tuple[str, str]]]:
    """First rows and column types, for a look at a source."""
    return df.limit(rows), df.dtypes
