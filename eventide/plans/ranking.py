"""Projection, filter, ordering, limit, deduplication and top-N queries over ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import ranking as R
from eventide.plans.registry import bucket_us, query, ts_of
from eventide.plans.windowing import EXACT_SQL, as_double, as_double_sql, events, exact

D = 86_400_000_000


@query("project_filter", """
SELECT user_id, event_type AS behavior, ts FROM events WHERE event_type = 'purchase'""")
def project_filter(spark, d):
    """``SELECT user_id, behavior, ts WHERE behavior = 'buy'``: filter and column list reach
    the parquet scan (PushedFilters / ReadSchema)."""
    return (events(spark, d).where(F.col("event_type") == "purchase")
            .select("user_id", F.col("event_type").alias("behavior"), "ts"))


@query("select_star", "SELECT * FROM events")
def select_star(spark, d):
    """``SELECT *`` pass-through."""
    return events(spark, d)


@query("latest_rows", "SELECT * FROM events ORDER BY event_id DESC LIMIT 10")
def latest_rows(spark, d):
    """``ORDER BY id DESC LIMIT 10`` (top-k report: the limit is the feature)."""
    return R.latest_rows(events(spark, d), [F.col("event_id").desc()], 10)


@query("bounded_peek", "SELECT * FROM events ORDER BY event_id LIMIT 100")
def bounded_peek(spark, d):
    """Peek at most 100 records from the beginning of the log (offset order = event_id)."""
    return R.latest_rows(events(spark, d), [F.col("event_id")], 100)


@query("run_filter_limit", """
SELECT * FROM events WHERE user_id = 7 ORDER BY event_id LIMIT 5""")
def run_filter_limit(spark, d):
    """Optional equality filter on the run key, then stop after N matches (N = 5)."""
    return R.run_rows(events(spark, d), "user_id", "7", [F.col("event_id")], 5)


@query("run_all_unbounded", "SELECT * FROM events")
def run_all_unbounded(spark, d):
    """A blank filter means all runs and N <= 0 means no stop: every record passes."""
    return R.run_rows(events(spark, d), "user_id", " ", [F.col("event_id")], 0)


@query("dedup_last", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def dedup_last(spark, d):
    """Keep the latest event per user (``ROW_NUMBER() OVER (... ts DESC) = 1``)."""
    return R.dedup_last(events(spark, d), ["user_id"], ["ts", "event_id"])


@query("dedup_first", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events) WHERE rn = 1""")
def dedup_first(spark, d):
    """Keep the first event per user."""
    return R.dedup_first(events(spark, d), ["user_id"], ["ts", "event_id"])


@query("top_n", """
SELECT event_id, user_id, value, rn FROM (
  SELECT event_id, user_id, value,
         row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn
  FROM events) WHERE rn <= 3""")
def top_n(spark, d):
    """Top 3 events per user by value."""
    ev = events(spark, d).select("event_id", "user_id", "value")
    out = R.top_n(ev, ["user_id"], [F.col("value").desc(), F.col("event_id")], 3)
    return out.withColumn("rn", F.col("rn").cast("long"))


@query("window_top_n", f"""
SELECT window_start, window_end, user_id, {as_double_sql('total')} AS total, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY total DESC, user_id) AS rn
  FROM (SELECT {ts_of(bucket_us('ts', D))} AS window_start,
               {ts_of(bucket_us('ts', D) + f' + {D}')} AS window_end,
               user_id, sum({EXACT_SQL}) AS total
        FROM events GROUP BY 1, 2, 3)) WHERE rn <= 3""")
def window_top_n(spark, d):
    """Top 3 users by value inside each 1-day window."""
    out = R.window_top_n(events(spark, d), "ts", "1 day", "user_id", exact(), 3)
    return out.withColumns({"total": as_double(F.col("total")), "rn": F.col("rn").cast("long")})


@query("window_dedup", f"""
SELECT window_start, window_end, event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, {ts_of(bucket_us('ts', D))} AS window_start,
         {ts_of(bucket_us('ts', D) + f' + {D}')} AS window_end,
         row_number() OVER (PARTITION BY user_id, {bucket_us('ts', D)} ORDER BY ts, event_id) AS rn
  FROM events) WHERE rn = 1""")
def window_dedup(spark, d):
    """First event per user inside each 1-day window."""
    return R.window_dedup(events(spark, d), "ts", "1 day", ["user_id"],
                          ["ts", "event_id"])
