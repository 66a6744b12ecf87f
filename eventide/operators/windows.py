"""Event-time windows as DataFrame helpers.

Row-level helpers (``tumble``, ``hop``, ``cumulate``) return the rows with ``window_start`` and
``window_end`` columns, the shape a windowing table-valued function has in SQL; a row belongs to
``[window_start, window_end)``, and grouping on those columns is an ordinary aggregation with a
partial (map-side) aggregate before the shuffle. Aggregating helpers (``hop_agg``,
``cumulate_agg``, ``session_agg``, ``count_window_agg``) return one row per window and are
written to keep every task bounded when one key or one window is huge.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventide.operators.scan import as_key, positions, with_pieces

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def duration_micros(duration: str) -> int:
    """Length of a duration string such as ``"10 minutes"`` or ``"1 hour 30 minutes"``."""
    total = 0
    parts = re.findall(r"(\d+)\s*([a-zA-Z]+)", duration)
    if not parts:
        raise ValueError(f"not a duration: {duration!r}")
    for num, unit in parts:
        unit = unit.lower().rstrip("s")
        if unit not in _UNIT_MICROS:
            raise ValueError(f"unknown unit {unit!r} in {duration!r}")
        total += int(num) * _UNIT_MICROS[unit]
    return total


def interval(duration: str) -> Column:
    """A day-time interval literal for timestamp arithmetic."""
    return F.expr(f"INTERVAL {duration_micros(duration)} MICROSECONDS")


def _with_window(df: DataFrame, w: Column) -> DataFrame:
    return (df.withColumn("__w", w)
              .withColumn("window_start", F.col("__w.start"))
              .withColumn("window_end", F.col("__w.end"))
              .drop("__w"))


def tumble(df: DataFrame, ts: str, size: str) -> DataFrame:
    """Tumbling windows of ``size``, aligned to the epoch."""
    return _with_window(df, F.window(ts, size))


def hop(df: DataFrame, ts: str, slide: str, size: str) -> DataFrame:
    """Hopping (sliding) windows. Argument order is (slide, size), as in the SQL HOP function.

    Each row appears once per window that covers it (``size / slide`` copies).
    """
    if duration_micros(size) % duration_micros(slide):
        raise ValueError("hop size must be a multiple of the slide")
    return _with_window(df, F.window(ts, size, slide))


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _as_ts_like(df: DataFrame, ts: str, micros: Column) -> Column:
    """Epoch microseconds back to a timestamp of the same type as ``df[ts]`` (NTZ stays NTZ)."""
    return F.timestamp_micros(micros).cast(df.schema[ts].dataType)


def cumulate(df: DataFrame, ts: str, step: str, max_size: str) -> DataFrame:
    """Cumulative windows: all windows of one ``max_size`` period share the start, and their
    ends grow by ``step``. A row at ``t`` belongs to every window whose end is after ``t``.

    Spark has no CUMULATE; the window start is the epoch-aligned ``max_size`` bucket of ``t``,
    the first end is the end of its ``step`` bucket, and the remaining ends are a ``sequence``
    up to ``start + max_size``: at most ``max_size / step`` copies per row, which the partial
    aggregate after it folds before the shuffle.
    """
    step_us, max_us = duration_micros(step), duration_micros(max_size)
    if max_us % step_us:
        raise ValueError("cumulate max size must be a multiple of the step")
    t = _micros(ts)
    start = F.floor(t / F.lit(max_us)).cast("long") * F.lit(max_us)
    first_end = (F.floor(t / F.lit(step_us)).cast("long") + 1) * F.lit(step_us)
    ends = F.sequence(first_end, start + F.lit(max_us), F.lit(step_us))
    return (df.withColumn("window_start", _as_ts_like(df, ts, start))
              .withColumn("window_end", F.explode(ends))
              .withColumn("window_end", _as_ts_like(df, ts, F.col("window_end"))))


def session_agg(df: DataFrame, keys: list[str], ts: str, gap: str, *aggs: Column) -> DataFrame:
    """Session windows per key: rows closer than ``gap`` merge; a session ends ``gap`` after
    its last row. Returns ``keys, window_start, window_end`` and the aggregates.

    Batch form without a per-key task. The time axis is cut at global quantiles (every piece
    holds ~1/n of all rows, whatever the key). Inside each (key, piece) a row opens a session
    when it is ``gap`` or more after the previous row (``lag``), and the openings are counted.
    Only the first row of a piece needs outside information -- the last time of the key in
    earlier pieces -- which comes from a per-(key, piece) summary (at most one row per piece
    and key) joined back on ``(key, piece)``. The session number is the openings of earlier
    pieces plus the local count, and the sessions are a partial aggregate on
    ``(keys, session)``. Streams use ``session_window`` (``streaming.windows``).
    """
    gap_us = duration_micros(gap)
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    # rows of one instant lie in one session: any order among them will do, so the row's own
    # columns need not break ties, but a hash of them spreads an instant over pieces
    base = with_pieces(df.withColumns({"__t": t, "__key": as_key(keys),
                                       "__h": F.xxhash64(*df.columns)}), ["__t", "__h"])
    w = Window.partitionBy("__key", "__piece").orderBy("__t")
    loc = base.withColumn("__lprev", F.lag("__t").over(w))
    loc = loc.withColumn("__lopen", (F.col("__lprev").isNotNull() &
                                     (F.col("__t") >= F.col("__lprev") + F.lit(gap_us))).cast("int"))
    loc = loc.withColumn("__lcum", F.sum("__lopen").over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    summary = loc.groupBy("__key", "__piece").agg(
        F.min("__t").alias("__first"), F.max("__t").alias("__last"),
        F.sum("__lopen").alias("__nopen"))
    earlier = Window.partitionBy("__key").orderBy("__piece").rowsBetween(
        Window.unboundedPreceding, -1)
    summary = summary.withColumn("__cprev", F.max("__last").over(earlier))
    summary = summary.withColumn("__fopen", (F.col("__cprev").isNull() | (
        F.col("__first") >= F.col("__cprev") + F.lit(gap_us))).cast("int"))
    summary = summary.withColumn("__copens", F.coalesce(
        F.sum(F.col("__nopen") + F.col("__fopen")).over(earlier), F.lit(0)))

    joined = loc.join(summary.select("__key", "__piece", "__fopen", "__copens"),
                      ["__key", "__piece"])
    sid = (F.col("__copens") + F.col("__fopen") + F.col("__lcum")).alias("__sid")
    out = joined.groupBy(*keys, sid).agg(
        F.min(ts).alias("window_start"), (F.max(ts) + interval(gap)).alias("window_end"), *aggs)
    return out.drop("__sid")


def window_count_agg(df: DataFrame, keys: list[str] | None = None,
                     name: str = "cnt") -> DataFrame:
    """COUNT(*) per window (and keys) after one of the helpers above."""
    keys = list(keys or [])
    return df.groupBy("window_start", "window_end", *keys).agg(F.count(F.lit(1)).alias(name))


def count_window_agg(df: DataFrame, order_cols: list[str], n: int, *aggs: Column,
                     name: str = "window_id") -> DataFrame:
    """Count windows of ``n`` consecutive rows in ``order_cols`` order, aggregated.

    Returns one row per full window with ``window_id`` (0-based), ``window_rows`` and the given
    aggregates. A trailing group shorter than ``n`` never fires, so it is removed.
    """
    pos = positions(df, order_cols, "__pos")
    grouped = (pos.groupBy(F.expr(f"__pos div {int(n)}").alias(name))
                  .agg(F.count(F.lit(1)).alias("window_rows"), *aggs))
    return grouped.where(F.col("window_rows") == n)


# -- pane-based window aggregates ----------------------------------------------------------
# Hopping and cumulative windows overlap, so the row-level helpers above copy every row into
# each window that covers it (size/slide or max/step copies) before aggregating. For
# decomposable aggregates the rows are first reduced to panes -- slide (or step) sized
# tumbling buckets, one partial row per key and pane -- and only those partials are fanned out
# to the windows and combined. The row data goes through one partial aggregate; the fan-out
# touches one row per pane.

_PARTIAL = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
_COMBINE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def _panes(df: DataFrame, ts: str, pane_us: int, keys: list[str],
           aggs: dict[str, tuple[str, Column]]) -> DataFrame:
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    pane = (F.floor(t / F.lit(pane_us)).cast("long") * F.lit(pane_us)).alias("__pane")
    return df.groupBy(*keys, pane).agg(
        *[_PARTIAL[kind](col).alias(name) for name, (kind, col) in aggs.items()])


def _combine_windows(fanned: DataFrame, df: DataFrame, ts: str, keys: list[str],
                     aggs: dict[str, tuple[str, Column]]) -> DataFrame:
    out = fanned.groupBy(*keys, "__ws", "__we").agg(
        *[_COMBINE[kind](F.col(name)).alias(name) for name, (kind, _) in aggs.items()])
    return out.select(_as_ts_like(df, ts, F.col("__ws")).alias("window_start"),
                      _as_ts_like(df, ts, F.col("__we")).alias("window_end"),
                      *keys, *aggs)


def hop_agg(df: DataFrame, ts: str, slide: str, size: str,
            aggs: dict[str, tuple[str, Column]], keys: list[str] | None = None) -> DataFrame:
    """Hopping-window aggregate (``name -> (count|sum|min|max, column)``) through panes."""
    keys = list(keys or [])
    slide_us, size_us = duration_micros(slide), duration_micros(size)
    if size_us % slide_us:
        raise ValueError("hop size must be a multiple of the slide")
    panes = _panes(df, ts, slide_us, keys, aggs)
    starts = F.sequence(F.col("__pane") - F.lit(size_us - slide_us), F.col("__pane"),
                        F.lit(slide_us))
    fanned = (panes.withColumn("__ws", F.explode(starts))
                   .withColumn("__we", F.col("__ws") + F.lit(size_us)))
    return _combine_windows(fanned, df, ts, keys, aggs)


def cumulate_agg(df: DataFrame, ts: str, step: str, max_size: str,
                 aggs: dict[str, tuple[str, Column]], keys: list[str] | None = None) -> DataFrame:
    """Cumulative-window aggregate through step-sized panes."""
    keys = list(keys or [])
    step_us, max_us = duration_micros(step), duration_micros(max_size)
    if max_us % step_us:
        raise ValueError("cumulate max size must be a multiple of the step")
    panes = _panes(df, ts, step_us, keys, aggs)
    start = F.floor(F.col("__pane") / F.lit(max_us)).cast("long") * F.lit(max_us)
    ends = F.sequence(F.col("__pane") + F.lit(step_us), start + F.lit(max_us), F.lit(step_us))
    fanned = panes.withColumn("__ws", start).withColumn("__we", F.explode(ends))
    return _combine_windows(fanned, df, ts, keys, aggs)


def global_window(df: DataFrame, ts: str, size: str) -> DataFrame:
    """Unkeyed tumbling window over the whole stream (``windowAll``): a tumble with no key.
    The aggregation after it is still partial per task, so only one row per window and task
    reaches the final aggregate."""
    return tumble(df, ts, size)
