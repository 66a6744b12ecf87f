"""Aggregations: arg-max, running (per-row) aggregates, cascaded windows, word count, audits.

All grouped aggregates here are built-in declarative aggregates, so Catalyst runs them as a
partial aggregate before the shuffle and a final one after it: a hot group sends one partial
row per task, never its raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.operators import windows as W
from eventide.operators.scan import prefix_scan


def argmax(df: DataFrame, by: list[str], order: list[Column], keep: list[str]) -> DataFrame:
    """One row per ``by`` group: the ``keep`` columns of the row with the largest ``order``.

    ``order`` is compared as a struct, left to right; put a unique tie-break last (for a
    "lowest id wins" rule pass the negated id). ``max_by`` over structs is a partial aggregate,
    which Spark runs sorted by group (SortAggregate): use it on rows that are already reduced,
    and ``ranking.dedup_last`` to pick whole rows of a raw table.
    """
    best = F.max_by(F.struct(*[F.col(c) for c in keep]), F.struct(*order)).alias("__best")
    return df.groupBy(*by).agg(best).select(*by, *[F.col(f"__best.{c}").alias(c) for c in keep])


def window_sum(df: DataFrame, ts: str, size: str, key: str, value: Column,
               name: str = "total") -> DataFrame:
    """Sum of ``value`` per ``key`` and tumbling window (the keyed hourly aggregate)."""
    return (W.tumble(df, ts, size)
            .groupBy("window_start", "window_end", key)
            .agg(F.sum(value).alias(name)))


def cascaded_window_argmax(per_key: DataFrame, key: str, total: str) -> DataFrame:
    """Second, unkeyed window over the per-key window results: the key with the largest total
    per window. Ties go to the lowest key (the stream version depends on arrival order). Two
    hash aggregates: the largest total of a window, then the lowest key that reaches it."""
    win = ["window_start", "window_end"]
    best = per_key.groupBy(*win).agg(F.max(total).alias("__best"))
    reach = per_key.join(best, win).where(F.col(total) == F.col("__best"))
    return reach.groupBy(*win, total).agg(F.min(key).alias(key)).select(*win, key, total)


def hourly_tips(df: DataFrame, ts: str, driver: str, tip: Column,
                size: str = "1 hour") -> DataFrame:
    """Per window: the driver with the highest tip sum. Output ``window_end_ms`` (epoch
    milliseconds of the window end), ``driver_id``, ``tips``."""
    per = window_sum(df, ts, size, driver, tip, "tips")
    best = cascaded_window_argmax(per, driver, "tips")
    return best.select(
        F.unix_millis(F.col("window_end").cast("timestamp")).alias("window_end_ms"),
        F.col(driver).alias("driver_id"), "tips")


def running_count(df: DataFrame, keys: list[str], order_cols: list[str],
                  name: str = "running_count") -> DataFrame:
    """Emit every row with the number of rows of its key seen so far (itself included)."""
    return prefix_scan(df, keys, order_cols, {name: ("count", F.lit(1))})


def running_sum(df: DataFrame, keys: list[str], order_cols: list[str], value: Column,
                name: str = "running_sum") -> DataFrame:
    return prefix_scan(df, keys, order_cols, {name: ("sum", value)})


def running_argmax(df: DataFrame, keys: list[str], order_cols: list[str], value: str,
                   id_col: str) -> DataFrame:
    """Emit every row with the best row of its key so far: ``best_value`` and ``best_id``.
    On equal values the lowest ``id_col`` wins (the first seen, when ids follow arrival)."""
    rank = F.struct(F.col(value).alias("v"), (-F.col(id_col)).alias("neg_id"))
    out = prefix_scan(df, keys, order_cols, {"__best": ("max", rank)})
    return (out.withColumn("best_value", F.col("__best.v"))
               .withColumn("best_id", -F.col("__best.neg_id"))
               .drop("__best"))


def word_count(df: DataFrame, text: str, word: str = r"[\p{L}\p{M}\p{N}_]+",
               name: str = "cnt") -> DataFrame:
    """Lower-case, take the runs that match ``word`` (letters, marks, digits and underscores of
    any script), count per word. Common words are pre-counted per task by the partial aggregate
    before the shuffle."""
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(word), F.lit(0))
    return (df.select(F.explode(words).alias("word"))
              .groupBy("word").agg(F.count(F.lit(1)).alias(name)))


def completeness_audit(df: DataFrame, keys: list[str], expected: int,
                       name: str = "cnt") -> DataFrame:
    """Groups whose row count differs from ``expected`` (empty result = complete)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
              .where(F.col(name) != expected)
              .withColumn("expected", F.lit(expected).cast("long")))
