"""The click-count streaming job: JSON click records -> per-page 15 s window counts -> JSON.

Event time comes from the record's ``dd-MM-yyyy hh:mm:ss:SSS`` timestamp with a bounded
out-of-orderness watermark (200 ms); with ``processing_time`` the windows run over the arrival
time instead. The count is Spark's partial/final ``count`` (one shuffle on page and window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions import codec as C
from eventide.streaming.windows import window_agg_stream


def click_statistics(values: DataFrame, value: str = "value", delay: str = "200 milliseconds",
                     size: str = "15 seconds", processing_time: bool = False) -> DataFrame:
    """Window counts per page; columns ``window_start, window_end, page, count``."""
    rec = values.select(C.decode_json(value, C.CLICK_SCHEMA, failfast=True).alias("r"))
    clicks = rec.select(F.col("r.page").alias("page"),
                        C.parse_click_ts("r.timestamp").cast("timestamp").alias("ts"))
    if processing_time:
        clicks = clicks.withColumn("ts", F.current_timestamp())
    return window_agg_stream(clicks, "ts", delay, size, F.count(F.lit(1)).alias("count"),
                             keys=["page"])


def statistics_value():
    """``{"windowStart", "windowEnd", "page", "count"}`` as JSON text, with the click pattern."""
    return C.encode_json(
        C.click_ts_text("window_start").alias("windowStart"),
        C.click_ts_text("window_end").alias("windowEnd"),
        F.col("page"), F.col("count"))


def statistics_json(stats: DataFrame) -> DataFrame:
    """The statistics as one column ``value``: the shape a topic sink takes."""
    return stats.select(statistics_value().alias("value"))
