"""Tables that are replaced in one step.

A table is a folder of versions, each a data set of its own, and a folder of empty
marks whose names are a number and a version. The mark with the largest number
names the current version. A load writes a new version first and sets its mark
last: creating one empty file is atomic on every store Spark writes to, so readers
see the old table or the new one, and a load that fails leaves the old one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

#: Versions that stay: the current one, and the one that running readers may still hold.
KEEP = 2
_MARKS = "_current"


def _place(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The store of a path and the path, through Spark's own file systems."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _place(spark, path)
    return store.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    store, place = _place(spark, path)
    store.delete(place, True)


def _marks(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and version of each mark, ascending."""
    store, place = _place(spark, f"{path}/{_MARKS}")
    if not store.exists(place):
        return []
    names = [status.getPath().getName() for status in store.listStatus(place)]
    return sorted((int(number), version) for number, _, version in (name.partition("-") for name in names))


def current(spark: SparkSession, path: str) -> str | None:
    """Folder of the current version; None before the first load."""
    marks = _marks(spark, path)
    return f"{path}/{marks[-1][1]}" if marks else None


def publish(spark: SparkSession, path: str, write: Callable[[str], None], keep: int = KEEP) -> str:
    """Let ``write`` fill a new folder and make it the current version; returns the folder.

    If ``write`` fails, its folder is removed and the table stays as it was. Older
    versions go, but for the last ``keep``.
    """
    version = f"v{uuid.uuid4().hex}"
    folder = f"{path}/{version}"
    try:
        write(folder)
    except BaseException:
        remove(spark, folder)
        raise
    marks = _marks(spark, path)
    number = marks[-1][0] + 1 if marks else 1
    store, place = _place(spark, f"{path}/{_MARKS}/{number:012d}-{version}")
    store.create(place, False).close()
    for old_number, old in [*marks, (number, version)][:-keep]:
        # The mark first: a reader that looks again finds only whole versions.
        remove(spark, f"{path}/{_MARKS}/{old_number:012d}-{old}")
        remove(spark, f"{path}/{old}")
    return folder


#: Rows of a version by what became of them; a part may be missing.
ROWS, REJECTED = "rows", "rejected"


def write_parts(df: DataFrame, folder: str, problem: str | None = None, day: str | None = None) -> None:
    """Write the rows and, in the same pass, those with a ``problem`` once more with it, apart.

    ``day`` names the column of a table with a folder per day. Rows are brought
    together by part and day first, so each task writes few files; ``rebalance``
    cuts heavy days into several files and merges light ones.
    """
    if not problem:
        # One part: its folder is named outright, so nothing is sorted or dealt by it.
        target, folders = f"{folder}/part={ROWS}", [day] if day else []
    else:
        parts = F.when(F.col(problem).isNotNull(), F.array(F.lit(ROWS), F.lit(REJECTED))).otherwise(F.array(F.lit(ROWS)))
        df = df.withColumn("part", F.explode(parts))
        df = df.withColumn(problem, F.when(F.col("part") == REJECTED, F.col(problem)))
        target, folders = folder, ["part", *([day] if day else [])]
    if folders:
        df = df.hint("rebalance", *[F.col(c) for c in folders])
    df.write.option("compression", "snappy").partitionBy(*folders).parquet(target)


def read_version(spark: SparkSession, folder: str, schema: StructType, part: str = ROWS) -> DataFrame:
    """One part of a version, with the columns of ``schema``; empty where it has no such rows."""
    whole = StructType([*schema.fields]).add("part", StringType())
    return spark.read.schema(whole).parquet(folder).where(F.col("part") == part).select(*schema.names)


def read_current(spark: SparkSession, path: str, schema: StructType, part: str = ROWS) -> DataFrame:
    """One part of the current version; empty before the first load."""
    folder = current(spark, path)
    return spark.createDataFrame([], schema) if folder is None else read_version(spark, folder, schema, part)
