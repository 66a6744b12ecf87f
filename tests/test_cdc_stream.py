"""CDC fold, upsert table with restart and compaction, count windows and cascaded windows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventide.operators import aggs, cdc
from eventide.streaming import sinks
from eventide.streaming.stateful import count_window_stream
from eventide.streaming.windows import cascaded_argmax_stream
from tests.streamutil import run_to_end, write_batches

IMAGE = "id int, name string, place string"


def changes(spark, rows):
    """(op, seq, id, name, place) as JSON envelopes, decoded again."""
    df = spark.createDataFrame(rows, "op string, seq long, " + IMAGE)
    sent = cdc.envelope(df, F.col("op"), "seq", ["id"], ["id", "name", "place"])
    return cdc.decode(sent, "value", df.select("id", "name", "place").schema)


LOG = [("r", 1, 1, "Ada", "Oslo"), ("r", 2, 2, "Bo", "Turku"), ("c", 3, 3, "Cy", "Graz"),
       ("u", 4, 2, "Bo", "Lund"), ("d", 5, 3, None, None), ("u", 6, 1, "Ada", None),
       ("d", 7, 2, None, None), ("c", 8, 2, "Di", "Brno")]
NOW = [(1, "Ada", None), (2, "Di", "Brno")]


def test_envelopes_name_before_and_after(spark):
    df = spark.createDataFrame(LOG, "op string, seq long, " + IMAGE)
    sent = [r.value for r in cdc.envelope(df, F.col("op"), "seq", ["id"],
                                          ["id", "name", "place"]).collect()]
    assert sent[2] == '{"op":"c","seq":3,"before":null,"after":{"id":3,"name":"Cy","place":"Graz"}}'
    assert sent[4] == '{"op":"d","seq":5,"before":{"id":3},"after":null}'


def test_batch_fold(spark):
    got = cdc.materialize(changes(spark, LOG[::-1]), ["id"])
    assert sorted((r.id, r.name, r.place) for r in got.collect()) == NOW


def test_a_record_that_is_no_envelope_fails(spark):
    bad = spark.createDataFrame([("{nonsense",)], "value string")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        cdc.decode(bad, "value", spark.createDataFrame([], IMAGE).schema).collect()


@pytest.mark.parametrize("order", [range(8), reversed(range(8)), [7, 2, 4, 0, 6, 1, 5, 3]])
def test_table_in_any_batch_order_with_compaction(spark, tmp_path, order):
    rows = changes(spark, LOG)
    table = sinks.UpsertTable(spark, str(tmp_path), rows.schema, ["id"], "seq", "deleted",
                              compact_every=3)
    assert table.read().collect() == []
    for b, i in enumerate(order):
        batch = changes(spark, [LOG[i], LOG[i]])  # delivered twice
        table.write(batch, b)
        table.write(batch, b)                     # and the batch is retried
    assert sorted((r.id, r.name, r.place) for r in table.read().collect()) == NOW
    # what a reader folds is one base and the deltas after it
    now = table.manifest.latest()[1]
    assert now["upto"] == 4 and sorted(now["deltas"]) == ["5", "6", "7"]
    assert len(table.manifest.numbers()) <= table.keep + 2 * table.compact_every


class Stopped(Exception):
    pass


def test_a_writer_stopped_after_any_step_loses_nothing(spark, tmp_path):
    """Every step of every write is the last one once; the batch is then retried."""
    schema = spark.createDataFrame([], "k int, n int").schema
    batches = [[(1, 1), (2, 1)], [(1, 2)], [(3, 5)], [(2, 9), (4, 4)]]
    states, want = [{}], [(1, 2), (2, 9), (3, 5), (4, 4)]
    for batch in batches:
        states.append(states[-1] | dict(batch))

    def rows(table):
        return sorted(map(tuple, table.read().collect()))

    def run(path, stop_at=None):
        table = sinks.UpsertTable(spark, str(path), schema, ["k"], compact_every=2, keep=2)
        steps = []

        def done(step):
            steps.append(step)
            if len(steps) == stop_at:
                raise Stopped(step)
        table._done = done
        for b, batch in enumerate(batches):
            try:
                table.write(spark.createDataFrame(batch, schema).coalesce(1), b)
            except Stopped:
                # readers see the table before the batch or after it, never a part
                assert rows(table) in [sorted(s.items()) for s in states[b:b + 2]]
                table.write(spark.createDataFrame(batch, schema).coalesce(1), b)
        return steps, rows(table)

    steps, end = run(tmp_path / "whole")
    assert end == want
    assert {"base stored", "manifest prepared", "manifest swapped", "folder removed"} <= set(steps)
    for stop in range(1, len(steps) + 1):
        assert run(tmp_path / f"stop-{stop}", stop)[1] == want, steps[stop - 1]


def test_a_half_written_folder_is_never_read(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, n int").schema
    table = sinks.UpsertTable(spark, str(tmp_path), schema, ["k"], compact_every=2)
    rows = [(k, k) for k in range(200)]
    table.write(spark.createDataFrame(rows[:100], schema), 0)
    spark.createDataFrame(rows[:20], schema).write.parquet(f"{tmp_path}/data/base-half")
    table.write(spark.createDataFrame(rows[100:], schema), 1)
    table.write(spark.createDataFrame(rows[100:], schema), 1)
    assert table.read().count() == 200


def test_two_writers_do_not_both_commit(spark, tmp_path):
    schema = spark.createDataFrame([], "k int").schema
    one = sinks.UpsertTable(spark, str(tmp_path), schema, ["k"])
    name = one.manifest.prepare({"base": None, "upto": -1, "deltas": {}})
    one.write(spark.createDataFrame([(1,)], schema), 0)
    with pytest.raises(RuntimeError, match="another writer"):
        one.manifest.swap(name, 0)


def test_staged_batches_are_read_once(spark):
    staged = spark.createDataFrame([(0, "a", 1), (0, "b", 1), (0, "b", 2), (1, "c", 3)],
                                   "batch_id long, attempt string, v int")
    assert sorted(r.v for r in sinks.last_attempt(staged).collect()) == [1, 2, 3]


def test_table_without_versions_takes_the_latest_batch(spark, tmp_path):
    schema = "k int, n int"
    table = sinks.UpsertTable(spark, str(tmp_path), spark.createDataFrame([], schema).schema,
                              ["k"], compact_every=2)
    for b, rows in enumerate([[(1, 1), (2, 1)], [(1, 2)], [(3, 5)], [(2, 9)], [(1, 7)]]):
        table.write(spark.createDataFrame(rows, schema), b)
    assert sorted(map(tuple, table.read().collect())) == [(1, 7), (2, 9), (3, 5)]


@pytest.mark.parametrize("sizes", [(3, 4, 3), (10,), (1,) * 10])
def test_count_window_stream_in_any_order(spark, sizes):
    import random
    seq = list(range(1, 11))
    random.Random(len(sizes)).shuffle(seq)
    batches, at = [], 0
    for n in sizes:
        batches.append([{"seq": i, "v": i} for i in seq[at:at + n]])
        at += n
    src = spark.readStream.schema("seq long, v long").option("maxFilesPerTrigger", 1).json(
        write_batches(batches))
    got = sorted((r.window_id, r.total)
                 for r in run_to_end(count_window_stream(src, "seq", "v", 4, first=1)))
    assert got == [(0, 10), (1, 26)]


T0 = dt.datetime(2023, 5, 4, 6, 0)
# (driver, minute, tip): two drivers tie in the second hour, a third hour stays empty, and the
# best driver of the fourth hour has two tips that only together are the largest
FARES = [(7, 5, 2.5), (8, 59, 2.25), (8, 60, 4.0), (9, 61, 4.0), (7, 119, 3.75),
         (5, 181, 1.5), (6, 200, 2.0), (5, 239, 1.0)]
BEST = [(60, 7, 2.5), (120, 8, 4.0), (240, 5, 2.5)]
WANT = [(T0 + dt.timedelta(minutes=m), d, t) for m, d, t in BEST]


def test_hourly_best_batch(spark):
    df = spark.createDataFrame([(d, T0 + dt.timedelta(minutes=m), t) for d, m, t in FARES],
                               "driver long, ts timestamp_ntz, tip float")
    per = aggs.window_sum(df, "ts", "1 hour", "driver", F.col("tip"), "tips")
    best = aggs.cascaded_window_argmax(per, "driver", "tips")
    assert sorted((r.window_end, r.driver, float(r.tips)) for r in best.collect()) == WANT


def test_hourly_best_stream(spark):
    rows = [{"driver": d, "ts": (T0 + dt.timedelta(minutes=m)).isoformat() + "Z", "tip": t}
            for d, m, t in FARES]
    # a late sentinel far ahead closes every window (a finite source's final watermark)
    rows.append({"driver": 99, "ts": (T0 + dt.timedelta(hours=10)).isoformat() + "Z", "tip": 0.0})
    src = spark.readStream.schema("driver long, ts timestamp, tip double").option(
        "maxFilesPerTrigger", 1).json(write_batches([[r] for r in rows]))
    out = cascaded_argmax_stream(src, "ts", "0 seconds", "1 hour", "driver", F.col("tip"), "tips")
    got = sorted((r.window_end.replace(tzinfo=None), r.driver, r.tips) for r in run_to_end(out))
    assert got == WANT
