"""Streaming jobs as registered queries: each reads given tables (or records written from them)
as a stream, runs to the end of the input and returns what its sink holds. The watermark drops
no row: a replay is one micro-batch, or several in order of event time, and a lost row would fail
the query."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions import codec as C
from eventide.plans.records import click_json
from eventide.plans.registry import bucket_us, query, ts_of
from eventide.plans.windowing import (EXACT_SQL, H, _tumble_sql, as_double, as_double_sql, events,
                                      exact, purchases)
from eventide.session import scratch_path
from eventide.sources.tables import as_utc, read_table, read_table_stream
from eventide.streaming import clicks as K
from eventide.streaming.late import CorrectedCounts
from eventide.streaming.lookup import Dimension, LookupJoin
from eventide.streaming.ordered import RankedChanges, RunningResults, TemporalJoin
from eventide.streaming.replay import (StagedReplay, TimedReplay, land, upserted,
                                       upserted_in_order)
from eventide.streaming.sessions import Sessions
from eventide.streaming.stateful import BUCKETS, long_interval_alerts_stream, pair_streams
from eventide.streaming.windows import processing_time_window_stream, window_agg_stream

STATS_SCHEMA = T.StructType([
    T.StructField("windowStart", T.StringType()), T.StructField("windowEnd", T.StringType()),
    T.StructField("page", T.StringType()), T.StructField("count", T.LongType())])

# The click record's 12-hour pattern has no marker: afternoon times come back 12 h earlier.
_CLICK_TS = ("(date_trunc('millisecond', ts) - CASE WHEN hour(ts) >= 12 THEN INTERVAL 12 HOUR "
             "ELSE INTERVAL 0 HOUR END)")
_CLICK_START = bucket_us(_CLICK_TS, 15_000_000)


@query("click_count_job", f"""
SELECT event_type AS page,
       strftime({ts_of(_CLICK_START)}, '%d-%m-%Y %I:%M:%S:%g') AS window_start_text,
       count(*) AS click_count
FROM events GROUP BY event_type, {_CLICK_START}""")
def click_count_job(spark, d):
    """The click-count job: events as JSON click records in files, read as a stream (FAILFAST
    decode, 200 ms watermark) in several micro-batches by event time, counted per page and 15 s
    window, written as JSON statistics to an upsert sink. Update mode: the window that is still open at the end is there as well."""
    records = click_json(spark, d).select("value")
    records = records.withColumn("at", C.parse_click_ts(F.get_json_object(
        "value", "$.timestamp")).cast("timestamp"))

    def job(values):
        return K.click_statistics(values).select(
            "page", C.click_ts_text("window_start").alias("window_start_text"),
            K.statistics_value().alias("value"))

    kept = upserted_in_order(records, "at", "click-stats", job, ["page", "window_start_text"])
    back = kept.select(C.decode_json("value", STATS_SCHEMA, failfast=True).alias("s"))
    return back.select(F.col("s.page").alias("page"),
                       F.col("s.windowStart").alias("window_start_text"),
                       F.col("s.count").alias("click_count"))


@query("hourly_tips_stream", f"""
WITH per AS (
  SELECT {bucket_us('ts', H)} AS s, user_id, sum({EXACT_SQL}) AS c FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY c DESC, user_id) AS rn FROM per)
SELECT CAST((s + {H}) // 1000 AS BIGINT) AS window_end_ms, user_id AS driver_id,
       {as_double_sql('c')} AS tips
FROM r WHERE rn = 1""")
def hourly_tips_stream(spark, d):
    """Hourly tips on a stream in several micro-batches by event time: sums per driver and hour
    in update mode into an upsert table, the best driver of each hour from the table. The watermark
    follows the events without delay, so state is evicted behind it."""
    from eventide.operators import aggs
    ev = as_utc(events(spark, d).select("ts", "user_id", "value"))
    table = upserted_in_order(
        ev, "ts", "hourly-tips", lambda src: window_agg_stream(
            src, "ts", "0 seconds", "1 hour", F.sum(exact()).alias("total"), keys=["user_id"]),
        ["window_start", "user_id"])
    best = aggs.cascaded_window_argmax(table, "user_id", "total")
    return best.select(F.unix_millis("window_end").alias("window_end_ms"),
                       F.col("user_id").alias("driver_id"), as_double(F.col("total")).alias("tips"))


@query("late_corrections", _tumble_sql(H))
def late_corrections(spark, d):
    """Buy counts per hour of a stream that delivers the newest events first: rows of closed
    windows are not dropped but correct them, so the totals are those of the batch."""
    ev = as_utc(purchases(spark, d).select("ts"))
    replay = TimedReplay(ev, "ts", "late-events", newest_first=True)
    counts = CorrectedCounts(spark, scratch_path(spark, "late-counts"), ev.schema, "ts", "1 hour",
                             "5 minutes")
    replay.run(replay.stream(), counts.write, output_mode="append")
    return counts.read().select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                                F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                                F.col("cnt").alias("buy_cnt"))


def _arriving(records, ts: str, row_id: str):
    """``records`` with an arrival time up to 2 days after ``ts``, so that a replay by arrival
    brings the events of 2 days in any order."""
    spread = F.expr("INTERVAL 1 SECOND") * F.pmod(F.xxhash64(F.col(row_id), F.lit(1)), 172_800)
    return records.withColumn("arrival", F.col(ts).cast("timestamp") + spread)


@query("temporal_join_stream", """
SELECT p.event_id, p.user_id, p.ts, v.event_id AS view_id, v.ts AS view_ts
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view') v
  ON p.user_id = v.user_id AND p.ts >= v.ts""")
def temporal_join_stream(spark, d):
    """The temporal join on two streams that arrive out of order over several micro-batches: a
    purchase waits until the watermark has passed it, and gets the latest view before it."""
    ev = events(spark, d)
    p = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    v = ev.where(F.col("event_type") == "view").select(
        F.col("event_id").alias("view_id"), "user_id", F.col("ts").alias("view_ts"))
    both = TemporalJoin.merge(p, v, "user_id", "ts", "view_ts", "event_id", "view_id")
    replay = TimedReplay(_arriving(both, "at", "id"), "arrival", "temporal-join-feed")
    join = TemporalJoin(spark, scratch_path(spark, "temporal-join"), both.schema, "2 days")
    replay.run(replay.stream(), join.write, output_mode="append")
    join.finish()
    return join.read()


@query("running_results_stream", """
WITH w AS (
  SELECT event_id, user_id,
         count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_count,
         max({'v': value, 'neg_id': -event_id}) OVER (
           PARTITION BY user_id ORDER BY ts, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b
  FROM events)
SELECT event_id, user_id, running_count, b.v AS best_value, -b.neg_id AS best_id FROM w""")
def running_results_stream(spark, d):
    """Running count and arg-max per user on a stream that arrives out of order over several
    micro-batches: one output row per input row, in the order of the events' times."""
    ev = as_utc(events(spark, d).select("event_id", "user_id", "ts", "value"))
    replay = TimedReplay(_arriving(ev, "ts", "event_id"), "arrival", "running-feed")
    best = F.struct(F.col("value").alias("v"), (-F.col("event_id")).alias("neg_id"))
    running = RunningResults(
        spark, scratch_path(spark, "running"), ev.schema, "ts", "2 days", ["user_id"], "event_id",
        {"running_count": ("sum", F.lit(1).cast("long")), "best": ("max", best)})
    replay.run(replay.stream(), running.write, output_mode="append")
    running.finish()
    return running.read().select("event_id", "user_id", "running_count",
                                 F.col("best.v").alias("best_value"),
                                 (-F.col("best.neg_id")).alias("best_id"))


@query("top_n_stream", """
SELECT event_id, user_id, value, rn FROM (
  SELECT event_id, user_id, value,
         row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn
  FROM events) WHERE rn <= 3""")
def top_n_stream(spark, d):
    """Top 3 events per user by value on a stream: each micro-batch retracts the rows that its
    own beat; the changelog, folded by the upsert table, is the ranking."""
    ev = as_utc(events(spark, d).select("event_id", "user_id", "value", "ts"))
    replay = TimedReplay(ev, "ts", "top-n-feed", newest_first=True)
    ranked = RankedChanges(spark, scratch_path(spark, "top-n"), ev.drop("ts").schema, ["user_id"],
                           [F.col("value").desc(), F.col("event_id")], 3)
    replay.run(replay.stream(), ranked.write, output_mode="append")
    return ranked.read()


@query("session_window_stream", """
WITH e AS (SELECT CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS k, ts, value, event_id
           FROM events),
g AS (SELECT *, lag(ts) OVER (PARTITION BY k ORDER BY ts, event_id) AS prev_ts FROM e),
s AS (SELECT *, sum(CASE WHEN prev_ts IS NULL OR ts >= prev_ts + INTERVAL 20 MINUTE THEN 1 ELSE 0 END)
        OVER (PARTITION BY k ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT k, min(ts) AS window_start, max(ts) + INTERVAL 20 MINUTE AS window_end, count(*) AS cnt,
       max(value) AS best
FROM s GROUP BY k, sid""")
def session_window_stream(spark, d):
    """Sessions with a gap of 20 minutes on a stream that arrives out of order over several
    micro-batches, of keys one of which holds a third of the rows."""
    k = F.when(F.col("event_id") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("user_id"))
    ev = as_utc(events(spark, d).select("event_id", k.alias("k"), "ts", "value"))
    replay = TimedReplay(_arriving(ev, "ts", "event_id"), "arrival", "session-feed")
    sessions = Sessions(spark, scratch_path(spark, "sessions"), ev.schema, ["k"], "ts",
                        "20 minutes", "2 days", {"cnt": ("sum", F.lit(1).cast("long")),
                                                 "best": ("max", F.col("value"))})
    replay.run(replay.stream(), sessions.write, output_mode="append")
    sessions.finish()
    return sessions.read().select("k", F.col("window_start").cast("timestamp_ntz").alias(
        "window_start"), F.col("window_end").cast("timestamp_ntz").alias("window_end"), "cnt",
        "best")


@query("dim_lookup_stream", """
SELECT c.c_custkey, c.c_name, coalesce(
  CASE WHEN (n.n_nationkey + c.c_custkey % 4) % 3 = 0
       THEN n.n_name || '*' || CAST(c.c_custkey % 4 AS VARCHAR) ELSE n.n_name END, 'Others')
  AS nation_name
FROM customer c LEFT JOIN nation n
  ON c.c_nationkey = n.n_nationkey AND n.n_nationkey % 5 <> c.c_custkey % 4""")
def dim_lookup_stream(spark, d):
    """Customers as a stream in four micro-batches, looked up in a dimension that is refreshed
    for each of them and has changed meanwhile: names are new, and entries missing."""
    customers = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    replay = StagedReplay(customers.withColumn("stage", (F.col("c_custkey") % 4).cast("int")),
                          "stage", "customer-feed")
    stages = [int(name[8:]) for name in replay.ranges]
    key = F.col("n_nationkey")

    def nations(batch):
        b = stages[batch]
        name = F.when((key + b) % 3 == 0, F.concat("n_name", F.lit(f"*{b}"))).otherwise(
            F.col("n_name"))
        return read_table(spark, d, "nation").where(key % 5 != b).select(
            key.cast("long").alias("c_nationkey"), name.alias("nation"))

    dimension = Dimension(spark, scratch_path(spark, "nations"), T.StructType(
        [T.StructField("c_nationkey", T.LongType()), T.StructField("nation", T.StringType())]))
    join = LookupJoin(spark, scratch_path(spark, "customer-lookup"), customers.schema, dimension,
                      ["c_nationkey"], refresh=nations)
    replay.run(replay.stream(), join.write, output_mode="append")
    return join.read().select("c_custkey", "c_name",
                              F.coalesce("nation", F.lit("Others")).alias("nation_name"))


def ride_events_stream(spark, d):
    """STARTs (orders, at the order date) and ENDs (line items, at the ship date) of the same key
    as one stream: key, is_start, ts."""
    starts = read_table_stream(spark, d, "orders").select(
        F.col("o_orderkey").alias("key"), F.lit(True).alias("is_start"),
        F.col("o_orderdate").alias("ts"))
    ends = read_table_stream(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("key"), F.lit(False).alias("is_start"),
        F.col("l_shipdate").alias("ts"))
    return starts.unionByName(ends)


@query("long_ride_alerts_stream", """
WITH e AS (SELECT l_orderkey, min(l_shipdate) AS t FROM lineitem GROUP BY l_orderkey),
m AS (SELECT greatest((SELECT max(o_orderdate) FROM orders),
                      (SELECT max(l_shipdate) FROM lineitem)) AS t),
s AS (SELECT o_orderkey, min(o_orderdate) AS t FROM orders GROUP BY o_orderkey)
SELECT s.o_orderkey AS key, CASE WHEN e.t IS NULL THEN 'no_end' ELSE 'too_long' END AS reason,
       epoch_ms(s.t) AS start_ms, epoch_ms(e.t) AS end_ms
FROM s LEFT JOIN e ON s.o_orderkey = e.l_orderkey, m
WHERE e.t > s.t + INTERVAL 90 DAY OR (e.t IS NULL AND s.t + INTERVAL 90 DAY <= m.t - INTERVAL 1 HOUR)
""")
def long_ride_alerts_stream(spark, d):
    """The stateful alert: keyed state with event-time timers over both event streams. A START
    without END alerts when the watermark (latest event - 1 h) passes its limit; one that is
    still within its limit at the end of the input does not."""
    alerts = long_interval_alerts_stream(ride_events_stream(spark, d), "key", "is_start", "ts",
                                         limit="90 days", delay="1 hour", retention="3650 days",
                                         buckets=BUCKETS)
    return land(alerts, "long-ride-alerts")


@query("rides_fares_stream", """
SELECT o.o_orderkey, o.o_orderdate, o.o_totalprice, l.l_linenumber, l.l_extendedprice,
       l.l_shipdate
FROM orders o JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
                   ORDER BY l_shipdate DESC, l_linenumber DESC,
                            l_extendedprice DESC) AS rn FROM lineitem)
  WHERE rn = 1) l ON o.o_orderkey = l.l_orderkey""")
def rides_fares_stream(spark, d):
    """1:1 pairing of two streams that consumes on match: an order meets its line item; a line
    item shipped later replaces an earlier one that waits."""
    orders = read_table_stream(spark, d, "orders", utc_timestamps=False).select(
        "o_orderkey", "o_orderdate", "o_totalprice",
        F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("o_at"))
    # arrival: the ship date (whole days), then line number and price, in one number
    shipped = F.unix_micros(F.col("l_shipdate").cast("timestamp"))
    nth = F.col("l_linenumber").cast("long") * 1_000_000_000
    price = F.round(F.col("l_extendedprice") * 100).cast("long")
    items = read_table_stream(spark, d, "lineitem", utc_timestamps=False).select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_extendedprice", "l_shipdate",
        (shipped + nth + price).alias("l_at"))
    pairs = pair_streams(orders, items, "o_orderkey", "o_at", "l_at")
    return land(pairs, "rides-fares").select(
        "o_orderkey", "o_orderdate", "o_totalprice", "l_linenumber", "l_extendedprice",
        "l_shipdate")


@query("processing_time_totals", "SELECT count(*) AS total, count(*) > 0 AS windows FROM events")
def processing_time_totals(spark, d):
    """Windows over processing time: rows fall in the window of their arrival, so only the total
    over all windows is defined."""
    src = read_table_stream(spark, d, "events")
    counts = processing_time_window_stream(src, "0 seconds", "15 seconds",
                                           F.count(F.lit(1)).alias("cnt"))
    table = upserted(counts, "processing-time", ["window_start"])
    return table.agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("total"),
                     (F.count(F.lit(1)) > 0).alias("windows"))
