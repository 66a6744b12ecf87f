"""Windowed aggregations on streams (append mode with a watermark).

For append output Spark must see that the group key carries event time, so the stream forms
group by the ``window(...)`` struct of the watermarked column itself and flatten it only after
the aggregation. Cumulative windows have no built-in; their ``window_end`` is computed and the
watermark is placed on that column instead (a watermark on ``ts`` does not carry through the
``explode``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.operators.windows import duration_micros


def _flatten(out: DataFrame, keys: list[str]) -> DataFrame:
    agg_cols = [c for c in out.columns if c not in keys and c != "__w"]
    return out.select(F.col("__w.start").alias("window_start"),
                      F.col("__w.end").alias("window_end"), *keys, *agg_cols)


def window_agg_stream(df: DataFrame, ts: str, delay: str, size: str, *aggs: Column,
                      slide: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """Tumbling (or hopping, with ``slide``) window aggregate of a stream; each window is
    emitted once, when the watermark ``max(ts) - delay`` passes its end."""
    keys = list(keys or [])
    w = (F.window(ts, size, slide) if slide else F.window(ts, size)).alias("__w")
    out = df.withWatermark(ts, delay).groupBy(w, *keys).agg(*aggs)
    return _flatten(out, keys)


def session_agg_stream(df: DataFrame, ts: str, delay: str, gap: str, keys: list[str],
                       *aggs: Column) -> DataFrame:
    """Session windows on a stream, emitted when the watermark passes the session end."""
    w = F.session_window(ts, gap).alias("__w")
    out = df.withWatermark(ts, delay).groupBy(w, *keys).agg(*aggs)
    return _flatten(out, keys)


def cumulate_agg_stream(df: DataFrame, ts: str, delay: str, step: str, max_size: str,
                        *aggs: Column, keys: list[str] | None = None) -> DataFrame:
    """Cumulative windows on a stream. Every partial window ``[start, start + k * step)`` is
    emitted once, when the watermark on ``window_end`` (delay = ``max_size`` + ``delay``)
    passes it."""
    keys = list(keys or [])
    step_us, max_us = duration_micros(step), duration_micros(max_size)
    t = F.unix_micros(F.col(ts))
    start = F.floor(t / F.lit(max_us)).cast("long") * F.lit(max_us)
    first_end = (F.floor(t / F.lit(step_us)).cast("long") + 1) * F.lit(step_us)
    exploded = (df.withColumn("window_start", F.timestamp_micros(start))
                  .withColumn("__end", F.explode(F.sequence(first_end, start + F.lit(max_us),
                                                            F.lit(step_us))))
                  .withColumn("window_end", F.timestamp_micros(F.col("__end"))))
    lag_us = max_us + duration_micros(delay)
    wm = exploded.withWatermark("window_end", f"{lag_us // 1000} milliseconds")
    return wm.groupBy("window_start", "window_end", *keys).agg(*aggs)


def processing_time_window_stream(df: DataFrame, delay: str, size: str,
                                  *aggs: Column) -> DataFrame:
    """Global window over processing time: every row is stamped with the micro-batch's
    current time, and the stamp is watermarked so windows close."""
    stamped = df.withColumn("__proc_ts", F.current_timestamp())
    return window_agg_stream(stamped, "__proc_ts", delay, size, *aggs)


def cascaded_argmax_stream(df: DataFrame, ts: str, delay: str, size: str, key: str,
                           value: Column, total: str = "total") -> DataFrame:
    """Two chained event-time windows on a stream: sum per key and window, then per window
    the key with the largest sum (ties: lowest key). The second window runs over the first
    one's ``window_time`` (its last instant), so both stages use append mode and each window
    is emitted once."""
    per = (df.withWatermark(ts, delay)
             .groupBy(F.window(ts, size).alias("w1"), F.col(key))
             .agg(F.sum(value).alias(total)))
    per = per.select(F.window_time("w1").alias("__t"), key, total)
    best = (per.groupBy(F.window("__t", size).alias("__w"))
               .agg(F.max_by(F.struct(F.col(total), F.col(key)),
                             F.struct(F.col(total), -F.col(key))).alias("__b")))
    return best.select(F.col("__w.start").alias("window_start"),
                       F.col("__w.end").alias("window_end"),
                       F.col(f"__b.{key}").alias(key), F.col(f"__b.{total}").alias(total))
