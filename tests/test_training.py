from __future__ import annotations

from pyspark.sql import functions as F

from shopfloor.functions import text
from shopfloor.operators.training import trainer_rows

SCHEMA = "timestamp string, trainer string, employee_code string, phone string, `course name` string"


def test_rows_per_trainer(spark, rows):
    df = spark.createDataFrame(
        [
            ("3/4/2021 8:05:09", "nobody", "VN0001", "1", "a"),
            ("3/4/2021 8:05:09", "VN0001 - An", "VN 00 02", "091", "b"),
            ("13/4/2021", "VN0003, VN0004", "none", None, None),
            ("bad", "VN0005", None, "", "c"),
            ("3/4/2021 8:05:09", "vn0001", "VN0001", "1", "d"),
            ("3/4/2021 8:05:09", "VN12345", "VN12345", "1", "e"),
            (None, None, None, None, None),
        ],
        SCHEMA,
    )
    got = rows(trainer_rows(df), "position", "trainer", "timestamp", "employee_code", "phone", "course name")
    assert got == [
        (0, "VN0001", "2021-04-03", "VN0002", "'091", "b"),
        (0, "VN0003", "2021-04-13", "", "'", ""),
        (0, "VN0005", "", "", "'", "c"),
        (0, "VN1234", "2021-04-03", "VN1234", "'1", "e"),
        (1, "VN0004", "2021-04-13", "", "'", ""),
    ]


def test_first_token(spark):
    df = spark.createDataFrame([("Blue Hill Mall",), ("Solo",), ("",), (None,)], "n string")
    assert [r[0] for r in df.select(text.first_token(F.col("n"))).collect()] == ["Blue", "Solo", "", None]
