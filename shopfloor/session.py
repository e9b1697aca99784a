"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "shopfloor", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the operators are written for.

    ``master`` stays unset on a cluster (spark-submit supplies it). Extra
    settings use ``__`` for dots: ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {k.replace("__", "."): v for k, v in extra.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"shopfloor-{application}-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder(spark.sparkContext.applicationId)


# Folders made inside the innermost scope of the running thread.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; never one that exists already."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def working_tables(spark: SparkSession) -> Iterator[None]:
    """Remove the working folders made inside when the scope ends, by an error too.

    What has been read from them must be written or counted by then: a frame that is
    returned from the scope and run later finds its tables gone. Scopes nest.
    """
    made: list[str] = []
    outer = _made.set(made)
    try:
        yield
    finally:
        _made.reset(outer)
        for path in made:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where one result feeds several jobs. The written table outlives lost
    executors, cuts the lineage, and gives the optimizer real file sizes.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@lru_cache
def _package_archive(application: str) -> str:
    package = Path(__file__).resolve().parent
    path = f"{_local_folder(application)}/{package.name}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for module in sorted(package.rglob("*.py")):
            archive.write(module, module.relative_to(package.parent))
    return path


def ship_package(spark: SparkSession) -> None:
    """Let tasks that run Python import this package.

    Spark sends the archive from the driver to every executor, those that join
    later included. Done once per application.
    """
    context = spark.sparkContext
    name = Path(_package_archive(context.applicationId)).name
    if not any(f.rsplit("/", 1)[-1] == name for f in context.listFiles):
        context.addPyFile(_package_archive(context.applicationId))
