"""More stream forms: session windows, interval join, late data, processing-time windows."""

import datetime as dt

from pyspark.sql import functions as F

from eventide.streaming.joins import interval_join_stream
from eventide.streaming.windows import (processing_time_window_stream, session_agg_stream,
                                        window_agg_stream)
from tests.streamutil import run_to_end, write_batches

T0 = dt.datetime(2024, 1, 1)


def _iso(minutes):
    return (T0 + dt.timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%SZ")


def test_session_window_stream(spark):
    rows = [{"k": 1, "ts": _iso(m)} for m in (0, 300, 720)] + [{"k": 2, "ts": _iso(10)}]
    rows.append({"k": 9, "ts": _iso(100 * 60)})          # closes every session
    src = spark.readStream.schema("k long, ts timestamp").option("maxFilesPerTrigger", 1).json(
        write_batches([[r] for r in rows]))
    out = session_agg_stream(src, "ts", "0 seconds", "6 hours", ["k"], F.count(F.lit(1)).alias("n"))
    got = sorted((r.k, r.n) for r in run_to_end(out) if r.k != 9)
    assert got == [(1, 1), (1, 2), (2, 1)]


def test_interval_join_stream(spark):
    orders = [{"o_user": 1, "o_id": 1, "o_ts": _iso(600)}, {"o_user": 2, "o_id": 2, "o_ts": _iso(600)}]
    clicks = [{"user": 1, "c_id": 10, "c_ts": _iso(300)}, {"user": 1, "c_id": 11, "c_ts": _iso(100)},
              {"user": 2, "c_id": 12, "c_ts": _iso(601)}]
    o = spark.readStream.schema("o_user long, o_id long, o_ts timestamp").json(write_batches([orders]))
    c = spark.readStream.schema("user long, c_id long, c_ts timestamp").json(write_batches([clicks]))
    o = o.withColumnRenamed("o_user", "user")
    out = interval_join_stream(o, c, "user", "o_ts", "c_ts", "-6 hours", "0 seconds", "1 hour")
    assert sorted((r.o_id, r.c_id) for r in run_to_end(out)) == [(1, 10)]


def test_late_rows_behind_the_watermark_are_dropped(spark):
    # Spark drops a row that is behind the watermark of the *previous* batch, so the late row
    # comes two batches after the one that moved the watermark past it
    batches = [[{"ts": _iso(0)}], [{"ts": _iso(600)}], [{"ts": _iso(601)}],
               [{"ts": _iso(5)}], [{"ts": _iso(2000)}]]
    src = spark.readStream.schema("ts timestamp").option("maxFilesPerTrigger", 1).json(
        write_batches(batches))
    out = window_agg_stream(src, "ts", "1 minute", "1 hour", F.count(F.lit(1)).alias("n"))
    got = sorted((r.window_start.replace(tzinfo=None), r.n) for r in run_to_end(out))
    assert got[0] == (T0, 1)     # the late row did not reach the first window


def test_processing_time_window_counts_everything(spark):
    src = spark.readStream.schema("v long").json(write_batches([[{"v": i} for i in range(50)]]))
    out = processing_time_window_stream(src, "0 seconds", "5 seconds",
                                        F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"))
    got = run_to_end(out, output_mode="update")
    assert sum(r.n for r in got) == 50 and sum(r.s for r in got) == sum(range(50))


def test_dedup_streams_and_window_top_n(spark):
    from eventide.streaming.dedup import (dedup_first_stream, dedup_last_stream,
                                          window_top_n_stream)
    rows = [{"u": u, "v": v, "ts": _iso(m)} for u, v, m in
            [(1, 5, 0), (1, 7, 10), (2, 1, 20), (2, 9, 30), (3, 4, 40), (1, 2, 50)]]
    rows.append({"u": 9, "v": 0, "ts": _iso(500)})
    schema = "u long, v long, ts timestamp"

    def src():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(
            write_batches([[r] for r in rows]))

    first = run_to_end(dedup_first_stream(src(), ["u"], "ts", "1 hour"))
    assert sorted((r.u, r.v) for r in first if r.u != 9) == [(1, 5), (2, 1), (3, 4)]
    last = run_to_end(dedup_last_stream(src(), ["u"], [F.col("ts")]), output_mode="update")
    final = {}
    for r in last:
        final[r.u] = r.v          # update mode: later batches overwrite
    assert {k: v for k, v in final.items() if k != 9} == {1: 2, 2: 9, 3: 4}
    ranked = []
    agg, rank = window_top_n_stream(src(), "ts", "0 seconds", "1 hour", "u", F.col("v"), 2,
                                    lambda df, i: ranked.extend(df.collect()))
    q = (agg.writeStream.outputMode("append").foreachBatch(rank)
         .option("checkpointLocation", __import__("tempfile").mkdtemp())
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert sorted((r.u, r.total, r.rn) for r in ranked) == [(1, 14, 1), (2, 10, 2)]


def test_running_count_and_argmax_streams(spark):
    from eventide.streaming.running import running_argmax_stream, running_count_stream
    batches = [[{"d": 1, "tip": 5.0, "id": 1}, {"d": 2, "tip": 1.0, "id": 2}],
               [{"d": 1, "tip": 7.0, "id": 3}], [{"d": 1, "tip": 7.0, "id": 4}]]
    folder = write_batches(batches)

    def src():
        return spark.readStream.schema("d long, tip double, id long").option(
            "maxFilesPerTrigger", 1).json(folder)

    counts = run_to_end(running_count_stream(src(), ["d"]), output_mode="update")
    assert [(r.d, r.running_count) for r in counts if r.d == 1] == [(1, 1), (1, 2), (1, 3)]
    best = run_to_end(running_argmax_stream(src(), ["d"], "tip", "id"), output_mode="update")
    assert [(r.best_value, r.best_id) for r in best if r.d == 1][-1] == (7.0, 3)
