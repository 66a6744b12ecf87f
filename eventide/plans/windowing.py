"""Window and aggregation queries over ``events`` (``purchase`` stands for the ``buy`` event)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import aggs, windows as W
from eventide.plans.registry import bucket_us, query, ts_of
from eventide.sources.tables import read_table, spread

H = 3_600_000_000
M = 60_000_000
S = 1_000_000


def events(spark, d):
    return read_table(spark, d, "events")


def purchases(spark, d):
    return events(spark, d).where(F.col("event_type") == "purchase")


# Amounts are taken to 1e-8 and summed as DECIMAL, so sums do not depend on the order of rows and
# hold up to 1e30.
EXACT_SQL = "CAST(value AS DECIMAL(28, 8))"


def exact(col: str = "value"):
    """A DOUBLE amount as DECIMAL(28, 8): rounded to 1e-8; 1e20 and more is an error."""
    return F.col(col).cast("decimal(28,8)")


def as_double(total):
    """A DECIMAL sum as the nearest DOUBLE."""
    return total.cast("double")


def as_double_sql(total: str) -> str:
    return f"CAST({total} AS DOUBLE)"


def _tumble_sql(size_us: int) -> str:
    return f"""
SELECT {ts_of(bucket_us('ts', size_us))} AS window_start,
       {ts_of(bucket_us('ts', size_us) + f' + {size_us}')} AS window_end,
       count(*) AS buy_cnt
FROM events WHERE event_type = 'purchase'
GROUP BY 1, 2"""


def _tumble(size: str):
    def fn(spark, d):
        return W.window_count_agg(W.tumble(purchases(spark, d), "ts", size), name="buy_cnt")
    fn.__doc__ = f"COUNT of buy events per {size} tumbling window."
    return fn


query("tumble_1h", _tumble_sql(H))(_tumble("1 hour"))
query("tumble_30s", _tumble_sql(30 * S))(_tumble("30 seconds"))


def _hop_sql(slide_us: int, size_us: int) -> str:
    b = bucket_us("ts", slide_us)
    return f"""
SELECT {ts_of('s')} AS window_start, {ts_of(f's + {size_us}')} AS window_end, count(*) AS buy_cnt
FROM (SELECT unnest(generate_series({b} - {size_us - slide_us}, {b}, {slide_us})) AS s
      FROM events WHERE event_type = 'purchase')
GROUP BY s"""


def _hop(slide: str, size: str):
    def fn(spark, d):
        return W.hop_agg(purchases(spark, d), "ts", slide, size,
                         {"buy_cnt": ("count", F.lit(1))})
    fn.__doc__ = f"COUNT of buy events per hopping window (slide {slide}, size {size})."
    return fn


query("hop_5m_1h", _hop_sql(5 * M, H))(_hop("5 minutes", "1 hour"))
query("hop_10s_30s", _hop_sql(10 * S, 30 * S))(_hop("10 seconds", "30 seconds"))


def _cumulate_sql(step_us: int, max_us: int) -> str:
    start = bucket_us("ts", max_us)
    first_end = bucket_us("ts", step_us) + f" + {step_us}"
    return f"""
SELECT {ts_of('s')} AS window_start, {ts_of('e')} AS window_end, count(*) AS buy_cnt
FROM (SELECT {start} AS s,
             unnest(generate_series({first_end}, {start} + {max_us}, {step_us})) AS e
      FROM events WHERE event_type = 'purchase')
GROUP BY s, e"""


def _cumulate(step: str, max_size: str):
    def fn(spark, d):
        return W.cumulate_agg(purchases(spark, d), "ts", step, max_size,
                              {"buy_cnt": ("count", F.lit(1))})
    fn.__doc__ = f"COUNT of buy events per cumulative window (step {step}, max {max_size})."
    return fn


query("cumulate_10m_1h", _cumulate_sql(10 * M, H))(_cumulate("10 minutes", "1 hour"))
query("cumulate_10s_1m", _cumulate_sql(10 * S, M))(_cumulate("10 seconds", "1 minute"))


@query("buy_cnt_per_hour", f"""
SELECT CAST(hour({ts_of(bucket_us('ts', H))}) AS BIGINT) AS hour_of_day, count(*) AS buy_cnt
FROM events WHERE event_type = 'purchase'
GROUP BY {bucket_us('ts', H)}""")
def buy_cnt_per_hour(spark, d):
    """Buy count per 1 h window keyed by the hour of day of the window start (one row per
    window, so an hour of day repeats across days)."""
    w = W.window_count_agg(W.tumble(purchases(spark, d), "ts", "1 hour"), name="buy_cnt")
    return w.select(F.hour("window_start").cast("long").alias("hour_of_day"), "buy_cnt")


@query("click_count", f"""
SELECT {ts_of(bucket_us('ts', 15 * S))} AS window_start,
       {ts_of(bucket_us('ts', 15 * S) + f' + {15 * S}')} AS window_end,
       event_type AS page, count(*) AS click_count
FROM events GROUP BY 1, 2, 3""")
def click_count(spark, d):
    """Clicks per page and 15 s tumbling window (event type stands for the page)."""
    ev = events(spark, d).select("ts", F.col("event_type").alias("page"))
    return W.window_count_agg(W.tumble(ev, "ts", "15 seconds"), ["page"], name="click_count")


@query("hourly_tips_per_driver", f"""
SELECT epoch_ms({ts_of(bucket_us('ts', H) + f' + {H}')}) AS window_end_ms,
       user_id AS driver_id,
       {as_double_sql(f'sum({EXACT_SQL})')} AS tips
FROM events GROUP BY 1, 2""")
def hourly_tips_per_driver(spark, d):
    """Sum of tips per driver and hour (user = driver, value = tip)."""
    per = aggs.window_sum(events(spark, d), "ts", "1 hour", "user_id", exact(), "total")
    return per.select(
        F.unix_millis(F.col("window_end").cast("timestamp")).alias("window_end_ms"),
        F.col("user_id").alias("driver_id"),
        as_double(F.col("total")).alias("tips"))


@query("hourly_tips", f"""
WITH per AS (
  SELECT {bucket_us('ts', H)} AS s, user_id, sum({EXACT_SQL}) AS c FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY c DESC, user_id) AS rn FROM per)
SELECT CAST((s + {H}) // 1000 AS BIGINT) AS window_end_ms, user_id AS driver_id,
       {as_double_sql('c')} AS tips
FROM r WHERE rn = 1""")
def hourly_tips(spark, d):
    """Cascaded windows: per hour, the driver with the largest tip sum (ties: lowest id)."""
    per = aggs.window_sum(events(spark, d), "ts", "1 hour", "user_id", exact(), "total")
    best = aggs.cascaded_window_argmax(per, "user_id", "total")
    return best.select(
        F.unix_millis(F.col("window_end").cast("timestamp")).alias("window_end_ms"),
        F.col("user_id").alias("driver_id"),
        as_double(F.col("total")).alias("tips"))


@query("running_count", """
SELECT event_id, user_id,
       count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_count
FROM events""")
def running_count(spark, d):
    """Running count per user, one output row per input row (order ts, event_id)."""
    ev = events(spark, d).select("event_id", "user_id", "ts")
    return aggs.running_count(ev, ["user_id"], ["ts", "event_id"]).select(
        "event_id", "user_id", "running_count")


@query("running_argmax", """
WITH w AS (
  SELECT event_id, user_id,
         max({'v': value, 'neg_id': -event_id}) OVER (
           PARTITION BY user_id ORDER BY ts, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b
  FROM events)
SELECT event_id, user_id, b.v AS best_value, -b.neg_id AS best_id FROM w""")
def running_argmax(spark, d):
    """Best (largest value) event of the user so far, emitted for every event."""
    ev = events(spark, d).select("event_id", "user_id", "ts", "value")
    return aggs.running_argmax(ev, ["user_id"], ["ts", "event_id"], "value", "event_id").select(
        "event_id", "user_id", "best_value", "best_id")


@query("global_time_window", f"""
SELECT {ts_of(bucket_us('ts', H))} AS window_start,
       {ts_of(bucket_us('ts', H) + f' + {H}')} AS window_end,
       count(*) AS cnt, {as_double_sql(f'sum({EXACT_SQL})')} AS total,
       format('time-window [{{}}, {{}}) count={{}} sum={{}}',
              {bucket_us('ts', H)} // 1000, ({bucket_us('ts', H)} + {H}) // 1000,
              count(*), CAST(sum({EXACT_SQL}) AS VARCHAR)) AS summary
FROM events GROUP BY {bucket_us('ts', H)}""")
def global_time_window(spark, d):
    """Unkeyed 1 h window over all events: count, sum and the formatted line."""
    w = W.global_window(events(spark, d), "ts", "1 hour")
    agg = w.groupBy("window_start", "window_end").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum(exact()).alias("__sum"))
    s_ms = F.unix_millis(F.col("window_start").cast("timestamp"))
    e_ms = F.unix_millis(F.col("window_end").cast("timestamp"))
    line = F.format_string("time-window [%d, %d) count=%d sum=%s", s_ms, e_ms, F.col("cnt"),
                           F.col("__sum").cast("string"))
    return agg.select("window_start", "window_end", "cnt", as_double(F.col("__sum")).alias("total"),
                      line.alias("summary"))


@query("count_window", f"""
SELECT w AS window_id, count(*) AS window_rows,
       {as_double_sql(f'sum({EXACT_SQL})')} AS total,
       'count-window sum=' || CAST(sum({EXACT_SQL}) AS VARCHAR) AS summary
FROM (SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // 4 AS w FROM events)
GROUP BY w HAVING count(*) = 4""")
def count_window(spark, d):
    """Count windows of 4 events in event_id order: sum per window; the trailing partial
    window never fires."""
    ev = events(spark, d).select("event_id", "value")
    out = W.count_window_agg(ev, ["event_id"], 4, F.sum(exact()).alias("__sum"))
    return out.select("window_id", "window_rows", as_double(F.col("__sum")).alias("total"),
                      F.concat(F.lit("count-window sum="), F.col("__sum").cast("string"))
                       .alias("summary"))


@query("session_window", f"""
WITH g AS (
  SELECT user_id, ts, event_id,
         lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts FROM events),
s AS (
  SELECT user_id, ts,
         sum(CASE WHEN prev_ts IS NULL OR ts >= prev_ts + INTERVAL 6 HOUR THEN 1 ELSE 0 END)
           OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid
  FROM g)
SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 6 HOUR AS window_end,
       count(*) AS cnt
FROM s GROUP BY user_id, sid""")
def session_window(spark, d):
    """Per-user sessions with a 6 h gap: start, end (last event + gap) and event count."""
    ev = events(spark, d).select("user_id", "ts")
    return W.session_agg(ev, ["user_id"], "ts", "6 hours", F.count(F.lit(1)).alias("cnt"))


@query("word_count", """
SELECT word, count(*) AS cnt
FROM (SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{N}_]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def word_count(spark, d):
    """Word frequencies over every document's full text; words are runs of letters, marks,
    digits and underscores of any script."""
    docs = spread(read_table(spark, d, "documents").select("text"))
    return aggs.word_count(docs, "text")
