"""Lead loads that append new files instead of overwriting the table.

Both run once over what has arrived since the last run and then stop, so they
are scheduled like the batch loads. The stream checkpoint makes each file count
exactly once, also after a failed run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from shopfloor.functions.phone import normalize_phone
from shopfloor.operators.align import lower_names
from shopfloor.operators.leads import first_of_day, lead_dedup
from shopfloor.schemas import LEAD_EXPORT, LEADS, SALES_CALLS, conform
from shopfloor.sinks.versions import exists, remove


def _append(rows: DataFrame, target: str, checkpoint: str, day: str) -> StreamingQuery:
    return (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .partitionBy(day)
        .trigger(availableNow=True)
        .start(target)
    )


def append_leads(
    spark: SparkSession, landed: str, target: str, checkpoint: str, schema: StructType = LEADS
) -> StreamingQuery:
    """New leads with clean phones, appended by day. No state and no shuffle."""
    arriving = lower_names(spark.readStream.schema(schema).parquet(landed))
    cleaned = arriving.withColumn("phone", normalize_phone(F.col("phone")))
    return _append(conform(cleaned, LEADS), target, checkpoint, "date")


def _touched(column: str, days: list[str | None]) -> Column:
    """Rows of some days as a plain filter on the partition column, so other days are not even listed."""
    named = F.col(column).isin([d for d in days if d is not None])
    return named | F.col(column).isNull() if None in days else named


def merge_first_calls(spark: SparkSession, calls: DataFrame, target: str) -> DataFrame:
    """The new first calls of the days that ``calls`` touch: theirs and those of ``target``, merged.

    The smallest (id, email) per key is kept, so merging in any order, or twice,
    gives the dedup of all calls that ever came. Of the target only the folders of
    touched days are read; the driver gets the names of these days, which the
    calendar bounds.
    """
    new = conform(lead_dedup(calls), LEAD_EXPORT)
    days = [r["created_at"] for r in new.select("created_at").distinct().collect()]
    if not exists(spark, target):
        return new
    old = spark.read.schema(LEAD_EXPORT).parquet(target).where(_touched("created_at", days))
    return conform(first_of_day(old.select(*LEAD_EXPORT.names).unionAll(new)), LEAD_EXPORT)


def append_first_calls(
    spark: SparkSession, landed: str, staged: str, target: str, checkpoint: str
) -> StreamingQuery:
    """Keep ``target`` equal to the batch dedup of all calls that ever landed.

    The target is the state: one folder per day with the first call of each key.
    A batch is merged with the days it touches, staged, and then put in their
    place, the folder of calls without a time included; a day's rows come in few
    files each time, so they never pile up. There is no watermark: no call is too
    late. A batch that runs again after a failure finds what it staged and only
    puts it in place; the folders of earlier batches are removed.
    """

    def add(calls: DataFrame, batch: int) -> None:
        ready = f"{staged}/batch={batch}"
        if not exists(spark, f"{ready}/_SUCCESS"):
            merge_first_calls(spark, calls, target).write.mode("overwrite").parquet(ready)
        (
            spark.read.schema(LEAD_EXPORT)
            .parquet(ready)
            .hint("rebalance", F.col("created_at"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("created_at")
            .parquet(target)
        )
        remove(spark, f"{staged}/batch={batch - 1}")

    return (
        spark.readStream.schema(SALES_CALLS)
        .parquet(landed)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
