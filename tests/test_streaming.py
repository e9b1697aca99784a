from __future__ import annotations

import shutil
from datetime import datetime

from shopfloor import schemas as S
from shopfloor.operators.leads import lead_dedup
from shopfloor.streaming.lead_append import append_first_calls, append_leads, merge_first_calls
from tests.helpers import plan_of


def lead(day, phone):
    moment = datetime(2021, 3, day)
    return (moment, moment.date(), phone, *[None] * (len(S.LEADS) - 3))


def test_new_files_are_appended_once(spark, tmp_path, rows):
    landed, target, state = (str(tmp_path / n) for n in ("landed", "leads", "state"))

    def run(*new):
        spark.createDataFrame(list(new), S.LEADS).write.mode("append").parquet(landed)
        append_leads(spark, landed, target, state).awaitTermination()
        return rows(spark.read.parquet(target), "date", "phone")

    first = run(lead(4, "912345678"), lead(5, "x"))
    assert [p for _, p in first] == ["0912345678", None]
    second = run(lead(4, "84912345679"))
    assert [p for _, p in second] == ["0912345678", "0912345679", None]
    assert sorted(p.name for p in (tmp_path / "leads").glob("date=*")) == ["date=2021-03-04", "date=2021-03-05"]


def test_first_calls_equal_the_batch_dedup_after_every_run(spark, tmp_path, rows):
    landed, staged, target, state = (str(tmp_path / n) for n in ("landed", "staged", "calls", "state"))

    def call(i, day, hour, name="a"):
        moment = None if day is None else datetime(2021, 3, day, hour)
        return (i, name, "1", f"{i}@x", None, "c", None, moment, None)

    def run(*new):
        spark.createDataFrame(list(new), S.SALES_CALLS).write.mode("append").parquet(landed)
        append_first_calls(spark, landed, staged, target, state).awaitTermination()
        streamed = rows(spark.read.schema(S.LEAD_EXPORT).parquet(target).select(*S.LEAD_EXPORT.names))
        assert streamed == rows(S.conform(lead_dedup(spark.read.parquet(landed)), S.LEAD_EXPORT))
        return {r[0] for r in streamed}

    assert run(call(2, 4, 10), call(3, 4, 11), call(4, 4, 9, "b"), call(9, None, 0)) == {2, 4, 9}
    # An earlier id, a second call without a time, and the last day of all.
    assert run(call(1, 4, 23), call(5, 6, 12), call(8, None, 0)) == {1, 4, 5, 8}
    # A day long past.
    assert run(call(7, 1, 12), call(6, 4, 1, "c")) == {1, 4, 5, 6, 7, 8}
    # Each day in one file, whatever the number of runs, and one staged batch.
    assert {len(list(p.glob("*.parquet"))) for p in (tmp_path / "calls").glob("created_at=*")} == {1}
    assert len(list((tmp_path / "staged").glob("batch=*"))) == 1


def test_merge_reads_touched_days_only(spark, tmp_path):
    def calls(*days):
        return spark.createDataFrame(
            [(i, "a", "1", None, None, "c", None, datetime(2021, 3, day), None) for i, day in enumerate(days)], S.SALES_CALLS
        )

    target = str(tmp_path / "calls")
    merge_first_calls(spark, calls(*range(1, 28)), target).write.partitionBy("created_at").parquet(target)
    merged = merge_first_calls(spark, calls(4, 5, 29), target)
    plan = plan_of(merged)
    assert "PartitionFilters: [" in plan and "2021-03-04" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert merged.count() == 3
    read = [f for f in merged.inputFiles()]
    assert {f.split("created_at=")[1].split("/")[0] for f in read if "created_at=" in f} >= {"2021-03-04", "2021-03-05"}


def test_a_batch_that_failed_while_put_in_place_is_repeated(spark, tmp_path, rows):
    """The days of the batch are lost from the target; what was staged brings them back."""
    landed, staged, target, state = (str(tmp_path / n) for n in ("landed", "staged", "calls", "state"))

    def land(*ids):
        frame = [(i, f"n{i}", "1", None, None, "c", None, datetime(2021, 3, 1 + i % 3), None) for i in ids]
        spark.createDataFrame(frame, S.SALES_CALLS).write.mode("append").parquet(landed)
        append_first_calls(spark, landed, staged, target, state).awaitTermination()

    land(1, 2, 3)
    land(4, 5)
    whole = rows(spark.read.schema(S.LEAD_EXPORT).parquet(target))
    shutil.rmtree(tmp_path / "calls" / "created_at=2021-03-02")
    for mark in ("1", ".1.crc"):
        (tmp_path / "state" / "commits" / mark).unlink()
    append_first_calls(spark, landed, staged, target, state).awaitTermination()
    assert rows(spark.read.schema(S.LEAD_EXPORT).parquet(target)) == whole
