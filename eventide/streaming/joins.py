"""Stream-stream joins with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.operators.joins import signed_micros
from eventide.operators.windows import duration_micros


def enrich_join_stream(left: DataFrame, right: DataFrame, key: str, l_ts: str, r_ts: str,
                       delay: str, tolerance: str) -> DataFrame:
    """1:1 keyed enrichment of two streams (e.g. ride START with its fare).

    Either side may arrive first. Both sides are watermarked and the join condition bounds
    the partner's time (``|l_ts - r_ts| <= tolerance``), so Spark evicts buffered rows once the
    watermark passes them: state stays bounded, unlike a buffer kept per key forever. Pairs
    further apart than ``tolerance`` do not meet, so it has to be chosen for the data.
    Column names of the two sides must differ except ``key``.
    """
    tol = duration_micros(tolerance)
    lw = left.withWatermark(l_ts, delay).withColumnRenamed(key, "__lk")
    rw = right.withWatermark(r_ts, delay)
    cond = (F.col("__lk") == F.col(key)) & \
        (F.col(r_ts) >= F.col(l_ts) - F.expr(f"INTERVAL {tol} MICROSECONDS")) & \
        (F.col(r_ts) <= F.col(l_ts) + F.expr(f"INTERVAL {tol} MICROSECONDS"))
    return lw.join(rw, cond, "inner").drop("__lk")


def interval_join_stream(left: DataFrame, right: DataFrame, key: str, l_ts: str, r_ts: str,
                         lower: str, upper: str, delay: str) -> DataFrame:
    """Stream form of the interval join: ``r_ts BETWEEN l_ts + lower AND l_ts + upper`` with
    watermarks on both sides (state is evicted once the bound is passed)."""
    lo, hi = signed_micros(lower), signed_micros(upper)
    lw = left.withWatermark(l_ts, delay).withColumnRenamed(key, "__lk")
    rw = right.withWatermark(r_ts, delay)
    cond = (F.col("__lk") == F.col(key)) & \
        (F.col(r_ts) >= F.col(l_ts) + F.expr(f"INTERVAL {lo} MICROSECONDS")) & \
        (F.col(r_ts) <= F.col(l_ts) + F.expr(f"INTERVAL {hi} MICROSECONDS"))
    return lw.join(rw, cond, "inner").drop("__lk")
