"""Window helpers on the reference's window examples, and stream == batch."""

import datetime as dt

from pyspark.sql import functions as F

from eventide.operators import windows as W
from eventide.sources.tables import read_table, read_table_stream
from eventide.streaming.windows import cumulate_agg_stream, window_agg_stream
from tests.conftest import SF001
from tests.streamutil import run_to_end


def _one_event(spark):
    return spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 7),)], "ts timestamp_ntz")


def _bounds(df):
    return sorted((r.window_start.strftime("%H:%M"), r.window_end.strftime("%H:%M"))
                  for r in df.select("window_start", "window_end").collect())


def test_tumble_10_minutes(spark):
    assert _bounds(W.tumble(_one_event(spark), "ts", "10 minutes")) == [("10:00", "10:10")]


def test_hop_size_10_slide_5(spark):
    got = _bounds(W.hop(_one_event(spark), "ts", "5 minutes", "10 minutes"))
    assert got == [("10:00", "10:10"), ("10:05", "10:15")]


def test_cumulate_step_10_max_60(spark):
    got = _bounds(W.cumulate(_one_event(spark), "ts", "10 minutes", "1 hour"))
    assert got == [("10:00", "10:10"), ("10:00", "10:20"), ("10:00", "10:30"),
                   ("10:00", "10:40"), ("10:00", "10:50"), ("10:00", "11:00")]


def test_count_window_drops_partial_tail(spark):
    ints = spark.range(1, 11).withColumnRenamed("id", "v")
    out = W.count_window_agg(ints, ["v"], 4, F.sum("v").alias("s"))
    assert sorted(r.s for r in out.collect()) == [10, 26]


def test_count_window_many_pieces(spark):
    ints = spark.range(0, 10_003).withColumnRenamed("id", "v")
    out = W.count_window_agg(ints, ["v"], 7, F.min("v").alias("lo"), F.max("v").alias("hi"))
    rows = out.collect()
    assert len(rows) == 10_003 // 7
    assert all(r.hi - r.lo == 6 and r.lo == 7 * r.window_id for r in rows)


def test_session_window_merges_close_rows(spark):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [(1, base), (1, base + dt.timedelta(hours=5)), (1, base + dt.timedelta(hours=12)),
         (2, base)], "k long, ts timestamp_ntz")
    out = W.session_agg(df, ["k"], "ts", "6 hours", F.count(F.lit(1)).alias("n"))
    got = sorted((r.k, r.n, r.window_end - r.window_start) for r in out.collect())
    assert got == [(1, 1, dt.timedelta(hours=6)), (1, 2, dt.timedelta(hours=11)),
                   (2, 1, dt.timedelta(hours=6))]


def _closed(batch_rows, watermark):
    return sorted(tuple(r) for r in batch_rows if r.window_end <= watermark)


def test_stream_tumble_equals_batch_for_closed_windows(spark):
    ev = read_table(spark, SF001, "events").where("event_type = 'purchase'")
    batch = W.window_count_agg(W.tumble(ev, "ts", "1 hour"), name="n")
    stream = window_agg_stream(
        read_table_stream(spark, SF001, "events").where("event_type = 'purchase'"),
        "ts", "0 seconds", "1 hour", F.count(F.lit(1)).alias("n"))
    got = sorted((r.window_start.replace(tzinfo=None), r.window_end.replace(tzinfo=None), r.n)
                 for r in run_to_end(stream))
    max_ts = ev.agg(F.max("ts")).first()[0]
    want = _closed(batch.select("window_start", "window_end", "n").collect(), max_ts)
    assert got == want and len(got) > 10


def test_stream_cumulate_equals_batch_for_closed_windows(spark):
    ev = read_table(spark, SF001, "events").where("event_type = 'purchase'")
    batch = W.window_count_agg(W.cumulate(ev, "ts", "10 minutes", "1 hour"), name="n")
    stream = cumulate_agg_stream(
        read_table_stream(spark, SF001, "events").where("event_type = 'purchase'"),
        "ts", "0 seconds", "10 minutes", "1 hour", F.count(F.lit(1)).alias("n"))
    got = sorted((r.window_start.replace(tzinfo=None), r.window_end.replace(tzinfo=None), r.n)
                 for r in run_to_end(stream))
    max_ts = ev.agg(F.max("ts")).first()[0]
    # the stream's watermark on window_end lags by the max window size
    want = _closed(batch.select("window_start", "window_end", "n").collect(),
                   max_ts - dt.timedelta(hours=1))
    assert got == want and len(got) > 10


def test_pane_aggregates_equal_row_level_windows(spark):
    ev = read_table(spark, SF001, "events")
    aggs = {"n": ("count", F.lit(1)), "s": ("sum", F.col("user_id")),
            "lo": ("min", F.col("value")), "hi": ("max", F.col("value"))}
    row_aggs = [F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("s"),
                F.min("value").alias("lo"), F.max("value").alias("hi")]
    cols = ["window_start", "window_end", "event_type", "n", "s", "lo", "hi"]
    pane = W.hop_agg(ev, "ts", "20 minutes", "2 hours", aggs, keys=["event_type"]).select(cols)
    rows = (W.hop(ev, "ts", "20 minutes", "2 hours")
            .groupBy("window_start", "window_end", "event_type").agg(*row_aggs).select(cols))
    assert pane.exceptAll(rows).count() == 0 and rows.exceptAll(pane).count() == 0
    pane = W.cumulate_agg(ev, "ts", "15 minutes", "2 hours", aggs, keys=["event_type"]).select(cols)
    rows = (W.cumulate(ev, "ts", "15 minutes", "2 hours")
            .groupBy("window_start", "window_end", "event_type").agg(*row_aggs).select(cols))
    assert pane.exceptAll(rows).count() == 0 and rows.exceptAll(pane).count() == 0


def test_stream_hop_equals_batch_for_closed_windows(spark):
    ev = read_table(spark, SF001, "events").where("event_type = 'purchase'")
    batch = W.hop_agg(ev, "ts", "20 minutes", "1 hour", {"n": ("count", F.lit(1))})
    stream = window_agg_stream(
        read_table_stream(spark, SF001, "events").where("event_type = 'purchase'"),
        "ts", "0 seconds", "1 hour", F.count(F.lit(1)).alias("n"), slide="20 minutes")
    got = sorted((r.window_start.replace(tzinfo=None), r.window_end.replace(tzinfo=None), r.n)
                 for r in run_to_end(stream))
    max_ts = ev.agg(F.max("ts")).first()[0]
    want = _closed(batch.select("window_start", "window_end", "n").collect(), max_ts)
    assert got == want and len(got) > 10
