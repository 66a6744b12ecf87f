"""Timed replays in many micro-batches, corrections of closed windows, null keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventide.sources.tables import as_utc
from eventide.streaming import replay as R
from eventide.streaming import sinks
from eventide.streaming.late import CorrectedCounts
from eventide.streaming.stateful import long_interval_alerts_stream
from eventide.streaming.windows import window_agg_stream
from tests.conftest import SF001
from tests.streamutil import run_to_end, write_batches


def purchases(spark):
    df = spark.read.parquet(f"{SF001}/events.parquet").select("ts", "user_id")
    return as_utc(df.orderBy(F.xxhash64("ts", "user_id")))  # in no order of time


def hourly(df):
    return {r.w: r.n for r in df.groupBy(F.window("ts", "1 hour").start.alias("w")).agg(
        F.count(F.lit(1)).alias("n")).collect()}


def test_many_batches_lose_nothing_and_evict_state(spark, tmp_path):
    df = purchases(spark)
    replay = R.TimedReplay(df, "ts", "replay-test", batches=6)
    out = window_agg_stream(replay.stream(), "ts", "0 seconds", "1 hour",
                            F.count(F.lit(1)).alias("n"))
    table = sinks.UpsertTable(spark, str(tmp_path), out.schema, ["window_start"])
    progress = replay.run(out, table.write)
    got = {r.window_start: r.n for r in table.read().collect()}
    assert got == hourly(df)
    full = [p for p in progress if p["rows"]]
    assert len(full) >= 5 and sum(p["rows"] for p in full) == df.count()
    marks = [p["watermark"] for p in progress]
    assert marks == sorted(marks) and len(set(marks)) >= 5
    assert max(p["state"] for p in progress) < len(got) / 2  # closed windows are gone
    assert not any(p["dropped"] for p in progress)


def test_a_dropped_row_fails_the_run(spark):
    replay = R.TimedReplay(purchases(spark), "ts", "replay-reverse", newest_first=True)
    out = window_agg_stream(replay.stream(), "ts", "0 seconds", "1 hour",
                            F.count(F.lit(1)).alias("n"))
    with pytest.raises(RuntimeError, match="later than the watermark"):
        replay.run(out, lambda batch, n: batch.collect())


@pytest.mark.parametrize("newest_first", [True, False])
def test_late_rows_correct_closed_windows(spark, tmp_path, newest_first):
    df = purchases(spark)
    replay = R.TimedReplay(df, "ts", "late-test", newest_first=newest_first)
    counts = CorrectedCounts(spark, str(tmp_path), df.schema, "ts", "1 hour", "5 minutes")

    def write(batch, n):
        counts.write(batch, n)
        if n == 2:
            counts.write(batch, n)  # a retry replaces the batch's share

    replay.run(replay.stream(), write, output_mode="append")
    rows = counts.read().collect()
    assert {r.window_start: r.cnt for r in rows} == hourly(df)
    assert (sum(r.late for r in rows) > 0) == newest_first


def test_rows_without_a_time_and_equal_times(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(None,)] * 3 + [(t,)] * 5, "ts timestamp")
    counts = CorrectedCounts(spark, str(tmp_path), df.schema, "ts", "1 hour", "0 seconds")
    replay = R.TimedReplay(df, "ts", "null-times")
    progress = replay.run(replay.stream(), counts.write, output_mode="append")
    assert sum(p["rows"] for p in progress) == 8
    assert [r.cnt for r in counts.read().collect()] == [5]


def test_null_keys_do_not_stop_the_alerts(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(None, True, 0), (1, True, 0), (1, False, 500), (None, False, 700), (2, True, 1)]
    random.Random(1).shuffle(rows)
    batches = [[{"key": k, "is_start": s, "ts": (t + dt.timedelta(minutes=m)).isoformat() + "Z"}
                for k, s, m in rows]]
    batches.append([{"key": 9, "is_start": False,
                     "ts": (t + dt.timedelta(days=9)).isoformat() + "Z"}])
    src = spark.readStream.schema("key long, is_start boolean, ts timestamp").option(
        "maxFilesPerTrigger", 1).json(write_batches(batches))
    got = run_to_end(long_interval_alerts_stream(src, "key", "is_start", "ts", "2 hours",
                                                 "0 seconds", "30 days"))
    assert sorted((r.key, r.reason) for r in got) == [(1, "too_long"), (2, "no_end")]
