"""Prefix scans under skew, positions, and joins against brute force on small fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventide.operators import joins as J
from eventide.operators.scan import positions, prefix_scan, with_pieces
from eventide.streaming.joins import enrich_join_stream
from tests.streamutil import run_to_end, write_batches


def _skewed(spark, n=20_000):
    # key 0 holds ~2/3 of all rows; the rest are spread over 50 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 != 0, F.lit(0)).otherwise(F.col("id") % 50 + 1).alias("k"),
        F.col("id").alias("t"), (F.col("id") * 7 % 101).alias("v"))


def test_prefix_scan_matches_window_under_skew(spark):
    df = _skewed(spark)
    got = prefix_scan(df, ["k"], ["t"], {"c": ("count", F.lit(1)), "s": ("sum", F.col("v")),
                                          "m": ("max", F.col("v"))})
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("k", "t", F.count(F.lit(1)).over(w).alias("c"),
                     F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("m"))
    assert got.select("k", "t", "c", "s", "m").exceptAll(want).count() == 0
    assert got.count() == df.count()


def test_pieces_bound_the_hot_key(spark):
    df = with_pieces(_skewed(spark), ["t"], 16)
    biggest = df.groupBy("k", "__piece").count().agg(F.max("count")).first()[0]
    assert biggest <= 20_000 // 16 + 200   # about 1/16 of all rows, not 2/3


@pytest.mark.parametrize("hot", [7, None, 0, 999])
def test_equal_order_values_are_cut_by_the_next_column(spark, hot):
    # 90 % of the rows share one order value
    value = F.when(F.col("id") % 10 != 0, F.lit(hot).cast("long")).otherwise(F.col("id") % 1000)
    df = spark.range(20_000).select((F.col("id") % 3).alias("k"), value.alias("t"), "id")
    cut = with_pieces(df, ["t", "id"], 32)
    sizes = [r["count"] for r in cut.groupBy("__piece").count().collect()]
    assert max(sizes) <= 3 * 20_000 // 32 and len(sizes) >= 32
    # pieces rise with the order
    order = cut.select("t", "id", "__piece").collect()
    order.sort(key=lambda r: (r.t is not None, r.t, r.id) if r.t is not None else (False, 0, r.id))
    seen = [r["__piece"] for r in order]
    assert seen == sorted(seen)
    got = prefix_scan(df, ["k"], ["t", "id"], {"c": ("count", F.lit(1))}, pieces=32)
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("k", "t", "id", F.count(F.lit(1)).over(w).alias("c"))
    assert got.select("k", "t", "id", "c").exceptAll(want).count() == 0
    pos = positions(df, ["t", "id"], pieces=32).collect()
    assert sorted(r.pos for r in pos) == list(range(20_000))


def test_pieces_follow_the_rows(spark, monkeypatch):
    from eventide.operators import scan
    monkeypatch.setattr(scan, "ROWS_PER_PIECE", 100)
    assert scan.default_pieces(spark.range(10_000)) >= 100


def test_exclusive_scan(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 3), (1, 3, 9), (2, 1, 4)], "k int, t int, v int")
    out = prefix_scan(df, ["k"], ["t"], {"prev_max": ("max", F.col("v"))}, exclusive=True)
    got = {(r.k, r.t): r.prev_max for r in out.collect()}
    assert got == {(1, 1): None, (1, 2): 5, (1, 3): 5, (2, 1): None}


def test_positions_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 3 + 1).alias("x"))
    got = sorted((r.x, r.pos) for r in positions(df, ["x"], pieces=9).collect())
    assert [p for _, p in got] == list(range(5000))


def _events(spark, rows):
    return spark.createDataFrame(rows, "id long, user_id long, ts timestamp_ntz")


def test_interval_join_equals_brute_force(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, i % 3, base + dt.timedelta(minutes=37 * i)) for i in range(200)]
    o = _events(spark, rows).select(F.col("id").alias("oid"), "user_id", F.col("ts").alias("ots"))
    c = _events(spark, rows).select(F.col("id").alias("cid"), "user_id", F.col("ts").alias("cts"))
    got = J.interval_join(o, c, "user_id", "ots", "cts", "-6 hours", "0 seconds")
    brute = o.join(c, "user_id").where(
        (F.col("cts") >= F.col("ots") - F.expr("INTERVAL 6 HOURS")) & (F.col("cts") <= F.col("ots")))
    assert sorted(map(tuple, got.select("oid", "cid").collect())) == \
        sorted(map(tuple, brute.select("oid", "cid").collect()))


def test_asof_join_equals_brute_force(spark):
    base = dt.datetime(2024, 1, 1)
    left = _events(spark, [(i, i % 4, base + dt.timedelta(minutes=13 * i)) for i in range(120)])
    right = _events(spark, [(1000 + i, i % 4, base + dt.timedelta(minutes=29 * i)) for i in range(50)])
    r = right.select(F.col("id").alias("rid"), "user_id", F.col("ts").alias("rts"))
    got = J.asof_join(left, r, "user_id", "ts", "rts", "id", "rid", ["rid", "rts"])
    cand = left.join(r, "user_id", "left").where(F.col("rts").isNull() | (F.col("rts") <= F.col("ts")))
    best = cand.groupBy("id").agg(F.max_by("rid", "rts").alias("rid"))
    want = left.select("id").join(best, "id", "left")
    assert sorted(map(tuple, got.select("id", "rid").collect())) == \
        sorted(map(tuple, want.select("id", "rid").collect()))


def test_dim_lookup_default(spark):
    facts = spark.createDataFrame([(1, 10), (2, 99)], "id int, cat int")
    dim = spark.createDataFrame([(10, "Books")], "cat int, name string")
    out = J.dim_lookup_join(facts, dim, "cat", "name", "Others", "parent")
    assert sorted((r.id, r.parent) for r in out.collect()) == [(1, "Books"), (2, "Others")]


RIDE_T0 = "2020-01-01T00:00:00Z"


def test_rides_and_fares_stream_pairs_either_order(spark):
    rides = [{"rideId": i, "isStart": True, "eventTime": RIDE_T0} for i in (1, 4, 3, 2)]
    rides.append({"rideId": 5, "isStart": False, "eventTime": RIDE_T0})  # END: ignored
    rides.append({"rideId": 7, "isStart": True, "eventTime": RIDE_T0})   # no fare
    fares = [{"fareRideId": i, "startTime": RIDE_T0, "tip": float(i)} for i in (2, 4, 1, 3, 9)]
    r = (spark.readStream.schema("rideId long, isStart boolean, eventTime timestamp")
         .json(write_batches([[x] for x in rides])).where("isStart"))
    f = (spark.readStream.schema("fareRideId long, startTime timestamp, tip double")
         .json(write_batches([[x] for x in fares])).withColumnRenamed("fareRideId", "rideId"))
    f = f.withColumnRenamed("rideId", "fare_ride")
    r = r.withColumnRenamed("rideId", "fare_ride")
    out = enrich_join_stream(r, f, "fare_ride", "eventTime", "startTime", "1 minute",
                             tolerance="0 seconds")
    got = sorted((x.fare_ride, x.tip) for x in run_to_end(out))
    assert got == [(1, 1.0), (2, 2.0), (3, 3.0), (4, 4.0)]


def test_session_agg_matches_spark_sessions_under_skew(spark):
    from eventide.operators import windows as W
    base = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))
    # key 0 holds most rows; gaps of 0..9 hours so sessions break often and cross pieces
    df = spark.range(6000).select(
        F.when(F.col("id") % 4 != 0, F.lit(0)).otherwise(F.col("id") % 7 + 1).alias("k"),
        (base + F.make_dt_interval(hours=(F.col("id") * 37 % 10) + F.col("id") * 5))
        .alias("ts"))
    got = W.session_agg(df, ["k"], "ts", "6 hours", F.count(F.lit(1)).alias("n"))
    want = (df.groupBy("k", F.session_window("ts", "6 hours").alias("w"))
              .agg(F.count(F.lit(1)).alias("n"))
              .select("k", F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), "n"))
    cols = ["k", "window_start", "window_end", "n"]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert want.select(cols).exceptAll(got.select(cols)).count() == 0


def test_null_keys_keep_their_rows(spark):
    from eventide.operators import windows as W
    df = spark.createDataFrame([(None, 1, 2), (None, 2, 3), (1, 1, 5)], "k int, t int, v int")
    out = prefix_scan(df, ["k"], ["t"], {"s": ("sum", F.col("v"))})
    assert {(r.k, r.t, r.s) for r in out.collect()} == {(None, 1, 2), (None, 2, 5), (1, 1, 5)}
    base = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([(None, base), (None, base + dt.timedelta(hours=1)), (1, base)],
                               "k int, ts timestamp_ntz")
    ses = W.session_agg(ev, ["k"], "ts", "6 hours", F.count(F.lit(1)).alias("n"))
    assert sorted((r.k is None, r.n) for r in ses.collect()) == [(False, 1), (True, 2)]
    left = spark.createDataFrame([(1, None, base)], "id long, user_id long, ts timestamp_ntz")
    right = spark.createDataFrame([(9, None, base)], "rid long, user_id long, rts timestamp_ntz")
    got = J.asof_join(left, right, "user_id", "ts", "rts", "id", "rid", ["rid"]).collect()
    assert [(r.id, r.rid) for r in got] == [(1, None)]


def test_operators_accept_empty_input(spark):
    from eventide.operators import aggs as A
    from eventide.operators import ranking as R
    from eventide.operators import windows as W
    empty = spark.createDataFrame([], "k long, id long, ts timestamp_ntz, v double")
    assert prefix_scan(empty, ["k"], ["ts", "id"], {"c": ("count", F.lit(1))}).count() == 0
    assert W.session_agg(empty, ["k"], "ts", "1 hour", F.count(F.lit(1)).alias("n")).count() == 0
    assert W.hop_agg(empty, "ts", "5 minutes", "1 hour", {"n": ("count", F.lit(1))}).count() == 0
    assert W.cumulate_agg(empty, "ts", "5 minutes", "1 hour", {"n": ("count", F.lit(1))}).count() == 0
    assert W.count_window_agg(empty, ["id"], 4, F.sum("v").alias("s")).count() == 0
    assert A.running_argmax(empty, ["k"], ["ts", "id"], "v", "id").count() == 0
    assert R.dedup_last(empty, ["k"], ["ts"]).count() == 0
    other = empty.select("k", F.col("id").alias("rid"), F.col("ts").alias("rts"))
    assert J.asof_join(empty, other, "k", "ts", "rts", "id", "rid", ["rid"]).count() == 0


def test_picks_take_one_row_per_key(spark):
    from eventide.operators import ranking as R
    base = dt.datetime(2024, 1, 1)
    rows = [(1, base, 5, "a"), (1, base, 6, "b"), (1, base - dt.timedelta(days=9), 7, "c"),
            (None, base, 1, "d"), (None, base, 1, "d"), (2, None, -3, "e"), (2, None, -9, "f")]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, id long, v string")
    assert sorted(r.v for r in R.dedup_last(df, ["k"], ["ts", "id"]).collect()) == ["b", "d", "e"]
    assert sorted(r.v for r in R.dedup_first(df, ["k"], ["ts", "id"]).collect()) == ["c", "d", "f"]
    big = spark.createDataFrame([(1, 2**62, -2**62, "x"), (1, 2**62, 2**62, "y"),
                                 (1, -2**62, 2**62, "z")], "k int, a long, b long, v string")
    assert [r.v for r in R.dedup_last(big, ["k"], ["a", "b"]).collect()] == ["y"]
    assert [r.v for r in R.dedup_first(big, ["k"], ["a", "b"]).collect()] == ["z"]


def test_limits_of_zero_and_blank_runs_are_unbounded(spark):
    from eventide.operators import ranking as R
    df = spark.range(20).select((F.col("id") % 2).cast("string").alias("run"), "id")
    assert R.latest_rows(df, [F.col("id")], 0).count() == 20
    assert R.run_rows(df, "run", None, [F.col("id")], -1).count() == 20
    assert R.run_rows(df, "run", "  ", [F.col("id")], 3).count() == 3
    assert R.run_rows(df, "run", "1", [F.col("id")], 0).count() == 10


def test_stream_interval_bounds_keep_microseconds(spark):
    from eventide.streaming.joins import interval_join_stream
    ts = ["2024-01-01T00:00:00.000000Z", "2024-01-01T00:00:00.000500Z"]
    a = spark.readStream.schema("k long, l_ts timestamp").json(write_batches([[{"k": 1, "l_ts": ts[0]}]]))
    b = spark.readStream.schema("k long, r_ts timestamp").json(write_batches([[{"k": 1, "r_ts": ts[1]}]]))
    out = interval_join_stream(a, b, "k", "l_ts", "r_ts", "0 seconds", "500 microseconds", "1 hour")
    assert len(run_to_end(out)) == 1


def test_word_count_keeps_every_script(spark):
    from eventide.operators import aggs as A
    df = spark.createDataFrame([("Naïve café 4G covid19 snake_case ÉTÉ été",), (None,), ("",)], "t string")
    assert {r.word: r.cnt for r in A.word_count(df, "t").collect()} == {
        "naïve": 1, "café": 1, "4g": 1, "covid19": 1, "snake_case": 1, "été": 2}
