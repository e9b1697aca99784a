"""Date and time rules. Times are wall-clock values without a zone."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day_first(text: Column) -> Column:
    """``31/12/2020`` or ``1/2/2020`` as a time; null for anything else."""
    return F.try_to_timestamp(text, F.lit("d/M/yyyy")).cast("timestamp_ntz")


def parse_day_first_with_time(text: Column) -> Column:
    """Day-first date with an optional time of day; null for anything else."""
    return F.try_to_timestamp(text, F.lit("d/M/yyyy[ H:m[:s]]")).cast("timestamp_ntz")


def parse_month_first(text: Column) -> Column:
    """ISO text or ``5/31/2020 10:20``; null for anything else."""
    us = F.try_to_timestamp(text, F.lit("M/d/yyyy[ H:m[:s]]"))
    return F.coalesce(F.try_to_timestamp(text), us).cast("timestamp_ntz")


def parse_zoned_as_utc(text: Column) -> Column:
    """Text with a zone offset as the UTC wall clock, whatever the session zone."""
    local = F.try_to_timestamp(text).cast("timestamp_ntz")
    return F.convert_timezone(None, F.lit("UTC"), local)


def day_text(moment: Column) -> Column:
    """``yyyy-MM-dd``; null stays null."""
    return F.date_format(moment, "yyyy-MM-dd")


def local_day(moment: Column, hours: int = 7) -> Column:
    """Calendar day after shifting the source clock forward."""
    return (moment + F.expr(f"INTERVAL '{int(hours)}' HOUR")).cast("date")


def local_day_start(day: date, hours: int = 7) -> Column:
    """The moment on the source clock at which a local day begins, as a literal."""
    moment = datetime.combine(day, time()) - timedelta(hours=hours)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def days_before(as_of: str, days: int) -> Column:
    """The date ``days`` before ``as_of`` (``yyyy-MM-dd``), as a literal."""
    return F.date_sub(F.lit(as_of).cast("date"), days)
