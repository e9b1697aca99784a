"""Text extraction and guards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: form of an employee code.
EMPLOYEE_CODE = "(VN[0-9]{4})"


def strip_spaces(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def employee_code(text: Column, pattern: str = EMPLOYEE_CODE) -> Column:
    """First code in the text after removing spaces; '' where there is none."""
    return F.regexp_extract(strip_spaces(text), pattern, 1)


def all_codes(text: Column, pattern: str = EMPLOYEE_CODE) -> Column:
    """Array of every code in the text, in order of appearance."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def sheet_text(text: Column) -> Column:
    """Leading apostrophe, so that a spreadsheet keeps the value as text."""
    return F.concat(F.lit("'"), text)


def first_token(text: Column, separator: str = " ") -> Column:
    return F.split_part(text, F.lit(separator), F.lit(1))


def starts_with(text: Column, prefix: str) -> Column:
    return F.left(text, F.lit(len(prefix))) == prefix
