"""Long-interval alerts (keyed state + event-time timers, and batch) and consuming pairs."""

import datetime as dt
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators import joins as J
from eventide.streaming.stateful import BUCKETS, long_interval_alerts_stream, pair_streams
from tests.streamutil import run_to_end, write_batches

T0 = dt.datetime(2022, 3, 5, 8, 0, 0)
SCHEMA = T.StructType([
    T.StructField("ride", T.LongType()),
    T.StructField("is_start", T.BooleanType()),
    T.StructField("at", T.TimestampType()),
])
PATTERN = "%Y-%m-%dT%H:%M:%SZ"


def ev(ride, is_start, minutes):
    return {"ride": ride, "is_start": is_start,
            "at": (T0 + dt.timedelta(minutes=minutes)).strftime(PATTERN)}


def S(ride, minutes):
    return ev(ride, True, minutes)


def E(ride, minutes):
    return ev(ride, False, minutes)


# an END far in the future on another key: moves the watermark so due timers fire
SENTINEL = E(-1, 100 * 60)


def alerts(spark, folder, delay="4 hours", retention="30 days", ck=None):
    src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(folder)
    out = long_interval_alerts_stream(src, "ride", "is_start", "at", "2 hours", delay, retention)
    if ck is None:
        return sorted((r.key, r.reason) for r in run_to_end(out))
    q = (out.writeStream.option("checkpointLocation", ck).format("noop")
         .trigger(availableNow=True).start())
    q.awaitTermination(300)


def stream_alerts(spark, arrivals, delay="4 hours", sentinel=True, per_batch=1):
    batches = [arrivals[i:i + per_batch] for i in range(0, len(arrivals), per_batch)]
    batches += [[SENTINEL]] if sentinel else []
    return alerts(spark, write_batches(batches), delay)


def batch_alerts(spark, arrivals):
    df = spark.createDataFrame(
        [(a["ride"], a["is_start"], dt.datetime.strptime(a["at"], PATTERN)) for a in arrivals],
        "ride long, is_start boolean, at timestamp")
    pairs = J.pair_start_end(df, "ride", F.col("is_start"), "at")
    return sorted((r.ride, "no_end" if r.end_ts is None else "too_long")
                  for r in J.long_interval_alerts(pairs, "2 hours").collect())


CASES = {
    "within_the_limit": ([S(4, 0), E(4, 45)], []),
    "end_comes_first": ([E(4, 45), S(4, 0)], []),
    "at_the_limit": ([S(4, 3), E(4, 123)], []),
    "just_over_it": ([S(4, 3), E(4, 124)], [(4, "too_long")]),
    "over_it_end_first": ([E(4, 300), S(4, 3)], [(4, "too_long")]),
    "never_ends": ([S(4, 10)], [(4, "no_end")]),
    "never_starts": ([E(4, 10)], []),
    "interleaved": ([S(11, 5), S(12, 6), E(13, 90), S(14, 30), E(11, 70), S(13, 2), E(14, 200)],
                    [(12, "no_end"), (14, "too_long")]),
    "start_twice": ([S(4, 0), S(4, 0)], [(4, "no_end")]),
    "later_start_again": ([S(4, 0), S(4, 200)], [(4, "no_end")]),
    "earlier_start_again": ([S(4, 100), S(4, 0), E(4, 130)], [(4, "too_long")]),
    "end_twice": ([S(4, 0), E(4, 60), E(4, 60)], []),
    "later_end_again": ([E(4, 500), E(4, 60), S(4, 0)], []),
    "all_again": ([S(4, 0), E(4, 150), S(4, 0), E(4, 150)], [(4, "too_long")]),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_cases(spark, name):
    arrivals, expected = CASES[name]
    assert stream_alerts(spark, arrivals) == expected
    assert batch_alerts(spark, arrivals) == expected
    assert stream_alerts(spark, arrivals, per_batch=len(arrivals)) == expected


def test_alert_waits_for_the_watermark(spark):
    # at the end of the input the watermark is one minute behind the second START, which is
    # past the first one's timer but not past its own
    both = [S(4, 0), S(5, 180)]
    assert stream_alerts(spark, both, delay="1 minute", sentinel=False) == [(4, "no_end")]
    assert stream_alerts(spark, both, delay="1 minute") == [(4, "no_end"), (5, "no_end")]


def test_end_after_the_timer_gives_one_alert(spark):
    got = stream_alerts(spark, [S(4, 0), S(5, 200), E(5, 210), E(4, 150)], delay="1 minute")
    assert got == [(4, "no_end")]


def test_state_is_kept_then_forgotten(spark):
    folder = write_batches([[S(4, 0)]])
    ck = tempfile.mkdtemp(prefix="eventide-lr-state-")

    def run(*more):
        for n, e in enumerate(more):
            with open(os.path.join(folder, f"more-{e['ride']}-{n}.json"), "w") as f:
                f.write(json.dumps(e) + "\n")
        alerts(spark, folder, retention="3 hours", ck=ck)
        rows = (spark.read.format("statestore").option("stateVarName", "seen").load(ck)
                .select("key.key", "value.done").collect())
        return {r.key: r.done for r in rows}

    assert run() == {4: False}                       # the START is remembered, its timer armed
    assert run(E(4, 1)) == {4: True}                 # decided: kept against redelivery
    assert 4 not in run(SENTINEL)                    # forgotten after the retention


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_arrival_order_within_the_delay_gives_the_batch_answer(spark, seed):
    rnd = random.Random(seed)
    events = []
    for ride in range(1, 9):
        start = rnd.randrange(0, 300)
        if rnd.random() < 0.8:
            events += [E(ride, start + rnd.choice([30, 119, 120, 121, 200]))]
        events += [S(ride, start)] * rnd.randint(1, 2)
    rnd.shuffle(events)                  # all within a 24 h watermark delay: nothing is late
    want = batch_alerts(spark, events)
    assert stream_alerts(spark, events, delay="24 hours", per_batch=4) == want


# -- pairs that are consumed when they meet ---------------------------------------------------

def pairs(spark, batches):
    """Each batch: (side, key, arrival, value) rows; a file a batch and side."""
    def side(n):
        return write_batches([[{"k": k, f"at{n}": a, f"v{n}": v} for s, k, a, v in b if s == n]
                              for b in batches])

    def src(n):
        return (spark.readStream.schema(f"k long, at{n} long, v{n} string")
                .option("maxFilesPerTrigger", 1).json(side(n)))
    got = run_to_end(pair_streams(src(0), src(1), "k", "at0", "at1"))
    return sorted((r.k, r.v0, r.v1) for r in got)


def test_pairs_meet_in_either_order(spark):
    assert pairs(spark, [[(0, 1, 1, "a"), (1, 2, 1, "x")], [(1, 1, 2, "b"), (0, 2, 2, "y")],
                         [(0, 3, 3, "left alone")]]) == [(1, "a", "b"), (2, "y", "x")]


def test_a_match_consumes_and_a_waiting_row_is_replaced(spark):
    assert pairs(spark, [[(0, 1, 1, "old")], [(0, 1, 2, "new")], [(1, 1, 3, "r1")],
                         [(1, 1, 4, "r2")], [(0, 1, 5, "third")]]) == [
        (1, "new", "r1"), (1, "third", "r2")]


def test_redelivery_within_a_batch_gives_one_pair(spark):
    one = [(0, 1, 1, "a"), (0, 1, 1, "a"), (1, 1, 2, "b"), (1, 1, 2, "b"), (1, 1, 3, "c")]
    assert pairs(spark, [one]) == [(1, "a", "c")]


def test_pairs_refuse_clashing_names(spark):
    df = spark.createDataFrame([(1, 1, "a")], "k long, at long, v string")
    with pytest.raises(ValueError):
        pair_streams(df, df, "k", "at", "at")


# -- the same by buckets of keys ---------------------------------------------------------------

def bucket_alerts(spark, folder, buckets=2, delay="4 hours", retention="30 days", ck=None):
    src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(folder)
    out = long_interval_alerts_stream(src, "ride", "is_start", "at", "2 hours", delay, retention,
                                      buckets=buckets)
    got: list = []
    q = (out.writeStream.option("checkpointLocation", ck or tempfile.mkdtemp())
         .foreachBatch(lambda b, _: got.extend(b.collect())).trigger(availableNow=True).start())
    q.awaitTermination(300)
    return sorted((r.key, r.reason) for r in got)


@pytest.mark.parametrize("per_batch", [1, 100])
def test_buckets_give_the_alerts_of_every_case(spark, per_batch):
    # every case on keys of its own, all in two buckets
    arrivals, want = [], []
    for n, name in enumerate(sorted(CASES)):
        events, expected = CASES[name]
        arrivals += [e | {"ride": 100 * n + e["ride"]} for e in events]
        want += [(100 * n + ride, reason) for ride, reason in expected]
    batches = [arrivals[i:i + per_batch] for i in range(0, len(arrivals), per_batch)]
    assert bucket_alerts(spark, write_batches([*batches, [SENTINEL]]), delay="24 hours") == want


def test_buckets_wait_for_the_watermark_and_alert_once(spark):
    assert bucket_alerts(spark, write_batches([[S(4, 0), S(5, 180)]]), delay="1 minute") == [
        (4, "no_end")]
    late = [[S(4, 0)], [S(5, 200)], [E(5, 210)], [E(4, 150)], [S(4, 230)]]
    assert bucket_alerts(spark, write_batches(late), delay="1 minute") == [(4, "no_end")]


def test_buckets_remember_over_a_restart_then_forget(spark):
    folder, ck = write_batches([[S(4, 0)], [S(6, 0)]]), tempfile.mkdtemp()

    def run(name, *events):
        with open(os.path.join(folder, name), "w") as f:
            f.writelines(json.dumps(e) + "\n" for e in events)
        got = bucket_alerts(spark, folder, 1, retention="3 hours", ck=ck)
        state = spark.read.format("statestore").load(ck).count()
        return got, state

    assert run("a.json", E(4, 150)) == ([(4, "too_long")], 1)
    assert run("b.json", E(4, 150), S(4, 0)) == ([], 1)             # a redelivery
    assert run("c.json", SENTINEL) == ([(6, "no_end")], 1)
    assert run("d.json", E(-1, 200 * 60)) == ([], 0)                # of repeated ENDs the earliest


def test_the_query_keeps_state_by_bucket(spark):
    """A state value per key costs several calls each: 150,000 keys took most of the bench."""
    from eventide.plans import REGISTRY
    from eventide.streaming import sinks
    seen = []
    run = sinks.run_to_end

    def watched(df, name, **options):
        q = run(df, name, **options)
        seen.append(max(o.numRowsTotal for p in q.recentProgress for o in p.stateOperators))
        return q
    sinks.run_to_end = watched
    try:
        for name in ("long_ride_alerts_stream", "rides_fares_stream"):
            REGISTRY[name].fn(spark, "/root/testdata/sf0.01").count()
    finally:
        sinks.run_to_end = run
    assert 0 < seen[0] <= BUCKETS and seen[1] <= BUCKETS


def test_pairs_without_an_arrival_come_first_and_ties_go_by_payload(spark):
    batch = [(0, 1, None, "z"), (0, 1, 5, "a"), (0, 1, 5, "b"), (1, 1, None, "x"), (1, 2, 1, "w")]
    assert pairs(spark, [batch, [(1, 2, 0, "v")], [(0, 2, 9, "c")]]) == [
        (1, "b", "x"), (2, "c", "v")]
