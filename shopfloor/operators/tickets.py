"""Support tickets: projections, custom fields and their labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.schemas import CALL_LOGS, TICKETS, conform

# Field ids of the care status and the receive status.
CARE_FIELD = 4871
RECEIVE_FIELD = 4893


def ticket_projection(tickets: DataFrame) -> DataFrame:
    return conform(tickets, TICKETS)


def call_log_projection(calls: DataFrame) -> DataFrame:
    return conform(calls, CALL_LOGS)


def custom_field_codes(
    fields: DataFrame, care: int = CARE_FIELD, receive: int = RECEIVE_FIELD
) -> DataFrame:
    """One row per ticket from (ticket, field, value) rows.

    Values are text; what is not a number counts as null. A field that repeats
    adds up, as in the source rule. Sums stay exact decimals, so large codes keep
    all digits; a sum with a fraction has no label.
    """

    def code(field: int, name: str):
        value = F.col("custom_filed_value").try_cast("decimal(28,4)")
        return F.sum(F.when(F.col("custom_filed_id") == field, value)).alias(name)

    return fields.groupBy("ticket_id").agg(
        code(care, "trang_thai_cham_soc"), code(receive, "trang_thai_tiep_nhan")
    )


def label_table(documents: DataFrame, position: int) -> DataFrame:
    """Values of the custom field at ``position`` as (id, lable) rows."""
    values = F.get(F.col("custom_fields"), F.lit(position))["values"]
    return documents.select(F.explode(values).alias("value")).select("value.id", "value.lable")


def label_custom_fields(codes: DataFrame, care: DataFrame, receive: DataFrame) -> DataFrame:
    """Replace both codes by their labels; null where a code has none.

    Codes are compared as whole numbers, so large ids stay exact; one with a
    fraction has no label. Tickets without a code go around the join, where they
    would all meet in one task.
    """

    def labelled(tickets: DataFrame, labels: DataFrame, code: str) -> DataFrame:
        whole = F.when(F.col(code) == F.floor(code), F.col(code).try_cast("bigint"))
        coded = tickets.withColumn("code", whole)
        names = labels.select(F.col("id").cast("bigint").alias("code"), F.col("lable").alias("label"))
        named = coded.where("code IS NOT NULL").join(names, "code", "left")
        plain = coded.where("code IS NULL").withColumn("label", F.lit(None).cast("string"))
        rest = [F.col(c) for c in tickets.columns if c != code]
        return named.select(*rest, F.col("label").alias(code)).unionByName(plain.select(*rest, F.col("label").alias(code)))

    first = labelled(codes, care, "trang_thai_cham_soc")
    return labelled(first, receive, "trang_thai_tiep_nhan").select(
        "ticket_id", "trang_thai_cham_soc", "trang_thai_tiep_nhan"
    )
