"""Training form responses: one row per named trainer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.functions.dates import day_text, parse_day_first_with_time
from shopfloor.functions.text import all_codes, employee_code, sheet_text


def trainer_rows(responses: DataFrame) -> DataFrame:
    """Explode each response into one row per trainer code it names.

    Responses that name none vanish. Missing text becomes '' and the phone gets
    the spreadsheet guard, so an empty phone reads ``'``. Other columns pass
    through as text.
    """
    own = {"timestamp", "trainer", "employee_code", "phone"}
    others = [c for c in responses.columns if c not in own]
    rows = responses.select(
        F.posexplode(all_codes(F.col("trainer"))).alias("position", "trainer_code"),
        day_text(parse_day_first_with_time(F.col("timestamp"))).alias("timestamp"),
        employee_code(F.col("employee_code")).alias("employee_code"),
        F.col("phone").cast("string").alias("phone"),
        *[F.col(f"`{c}`").cast("string").alias(c) for c in others],
    )
    return (
        rows.fillna("")
        .withColumn("phone", sheet_text(F.col("phone")))
        .withColumnRenamed("trainer_code", "trainer")
    )
