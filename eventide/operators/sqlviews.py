"""Windowing table-valued functions for Spark SQL users, as temp views.

Spark SQL has ``window()`` for GROUP BY but no ``TABLE(TUMBLE(...))`` / ``HOP`` / ``CUMULATE``
table-valued functions. ``register_window_view`` creates a temp view holding the source's
columns plus ``window_start`` / ``window_end`` (one row per window a row belongs to), so a
windowing query is written against that view:

    register_window_view(spark, "user_behavior", "tumble", "ts", "30 seconds",
                         name="ub_tumble_30s")
    spark.sql("SELECT window_start, window_end, COUNT(*) AS buy_cnt FROM ub_tumble_30s "
              "WHERE behavior = 'buy' GROUP BY window_start, window_end")

The view is the lazy DataFrame plan of the helpers in ``operators.windows``: Catalyst still
pushes the ``WHERE`` below the window expansion into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventide.operators import windows as W


def window_table(df: DataFrame, kind: str, ts: str, *durations: str) -> DataFrame:
    """``tumble(size)``, ``hop(slide, size)`` (the SQL argument order) or
    ``cumulate(step, max_size)`` of a DataFrame."""
    kind = kind.lower()
    if kind == "tumble":
        (size,) = durations
        return W.tumble(df, ts, size)
    if kind == "hop":
        slide, size = durations
        return W.hop(df, ts, slide, size)
    if kind == "cumulate":
        step, max_size = durations
        return W.cumulate(df, ts, step, max_size)
    raise ValueError(f"unknown window kind {kind!r}")


def register_window_view(spark: SparkSession, source: str, kind: str, ts: str, *durations: str,
                         name: str | None = None) -> str:
    """Create (or replace) a temp view of ``source`` (a table or view name) with window
    columns; returns the view name."""
    view = name or f"{source}_{kind.lower()}"
    window_table(spark.table(source), kind, ts, *durations).createOrReplaceTempView(view)
    return view


def drop_view(spark: SparkSession, name: str) -> None:
    """``DROP VIEW IF EXISTS`` for a session view."""
    spark.catalog.dropTempView(name)
