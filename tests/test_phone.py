from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import plan_of
from shopfloor.functions.phone import PREFIXES, known_prefix, normalize_phone, rewrite_prefix

NINE = "912345678"
CASES = [
    (None, None),
    ("", None),
    ("abc", None),
    ("12345678", None),
    (NINE, "0" + NINE),
    ("0" + NINE, "0" + NINE),
    ("1" + NINE, "01" + NINE),
    ("84" + NINE, "0" + NINE),
    ("01" + NINE, "01" + NINE),
    ("12" + NINE, "012" + NINE),
    ("841" + NINE, "01" + NINE),
    ("012" + NINE, None),
    ("123" + NINE, None),
    ("8412" + NINE, None),
    ("+84 912 345 678", "0" + NINE),
    ("0162-1234567", "01621234567"),
    ("٠١٢" + NINE, "0" + NINE),
]


def by_length(text):
    """The rule once more, by length and leading digits."""
    digits = re.sub("[^0-9]", "", text)
    keep, add, cut = digits, "0" + digits, "0" + digits[2:]
    table = {
        9: add,
        10: keep if digits[:1] == "0" else add,
        11: keep if digits[:1] == "0" else cut if digits[:2] == "84" else add,
        12: cut if digits[:2] == "84" else None,
    }
    return table.get(len(digits))


def frame(spark, values, column="phone"):
    return spark.createDataFrame(list(enumerate(values)), f"id int, {column} string")


def test_normalize_cases(spark):
    df = frame(spark, [c[0] for c in CASES]).select("id", normalize_phone(F.col("phone")).alias("p"))
    assert [r["p"] for r in df.orderBy("id").collect()] == [c[1] for c in CASES]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="0123456789848484 +-x", max_size=16), min_size=50, max_size=200))
def test_normalize_agrees_with_the_rule(spark, values):
    df = frame(spark, values).select("id", normalize_phone(F.col("phone")).alias("p"))
    assert [r["p"] for r in df.orderBy("id").collect()] == [by_length(v) for v in values]


def test_every_prefix(spark):
    assert len(PREFIXES) == 52
    numbers = [old + "1234567" for old in PREFIXES] + ["00001234567", None]
    df = frame(spark, numbers).select(
        "id", known_prefix(F.col("phone")).alias("known"), rewrite_prefix(F.col("phone")).alias("new")
    )
    got = [(r["known"], r["new"]) for r in df.orderBy("id").collect()]
    assert got == [(old + "1234567", new + "1234567") for old, new in PREFIXES.items()] + [(None, None)] * 2


# Fixed values, from the public renumbering of eleven-digit mobile numbers.
RENUMBERED = {
    "0120": "070", "0121": "079", "0122": "077", "0123": "083", "0124": "084", "0125": "085", "0126": "076",
    "0127": "081", "0128": "078", "0129": "082", "0199": "059",
} | {f"016{n}": f"03{n}" for n in range(2, 10)}


def test_eleven_digit_prefixes_follow_the_public_renumbering():
    assert {old: new for old, new in PREFIXES.items() if len(old) == 4} == RENUMBERED
    kept = {old for old, new in PREFIXES.items() if len(old) == 3 and old == new}
    assert len(kept) == len(PREFIXES) - len(RENUMBERED) and set(RENUMBERED.values()) <= kept


def test_phone_rules_stay_in_the_jvm(spark):
    df = frame(spark, ["1"])
    for rule in (normalize_phone, known_prefix, rewrite_prefix):
        assert "Python" not in plan_of(df.select(rule(F.col("phone"))))
