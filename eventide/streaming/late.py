"""Window totals of a stream whose late rows correct closed windows instead of being dropped.

Each micro-batch is split by the watermark of the batches before it: rows of windows that are
still open, and rows of windows that the watermark has closed. Both are aggregated (partially
before the shuffle) and stored as the batch's share of their windows in an upsert table keyed by
window, key and batch, so a retried batch replaces its share. A window's total is the sum of its
shares, and the late ones among them are its correction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators.windows import duration_micros
from eventide.streaming.sinks import UpsertTable


class CorrectedCounts:
    """Counts per tumbling window of ``size`` and ``keys`` of the rows given to ``write``, a
    ``foreachBatch`` writer. ``ts`` is a TIMESTAMP column; rows without a time are in no window.
    The watermark is the latest time of all earlier batches less ``delay``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, ts: str, size: str,
                 delay: str, keys: list[str] | None = None):
        self.spark, self.ts, self.keys = spark, ts, list(keys or [])
        self.size, self.delay = duration_micros(size), duration_micros(delay)
        kept = [f for f in schema.fields if f.name in self.keys]
        share = T.StructType([T.StructField("start", T.LongType()), *kept,
                              T.StructField("batch", T.LongType()),
                              T.StructField("late", T.BooleanType()),
                              T.StructField("n", T.LongType()),
                              T.StructField("top", T.LongType())])
        self.shares = UpsertTable(spark, f"{path}/shares", share,
                                  ["start", *self.keys, "batch"])

    def watermark(self, batch_id: int) -> int | None:
        """Epoch microseconds up to which windows were closed when the batch came."""
        top = self.shares.read().where(F.col("batch") < batch_id).agg(F.max("top")).first()[0]
        return None if top is None else top - self.delay

    def write(self, batch: DataFrame, batch_id: int) -> None:
        closed = self.watermark(batch_id)
        at = F.unix_micros(F.col(self.ts))
        start = (F.floor(at / self.size) * self.size).cast("long")
        late = F.lit(False) if closed is None else F.col("start") + self.size <= closed
        shares = (batch.where(F.col(self.ts).isNotNull()).withColumn("start", start)
                       .groupBy("start", *self.keys).agg(F.count(F.lit(1)).alias("n"),
                                                     F.max(at).alias("top"))
                       .select("start", *self.keys, F.lit(batch_id).cast("long").alias("batch"),
                               late.alias("late"), "n", "top"))
        self.shares.write(shares, batch_id)

    def read(self) -> DataFrame:
        """window_start, window_end, keys, cnt, and late: how many of them came after the
        window was closed."""
        return self.shares.read().groupBy("start", *self.keys).agg(
            F.sum("n").alias("cnt"),
            F.coalesce(F.sum(F.when(F.col("late"), F.col("n"))), F.lit(0)).alias("late")).select(
                F.timestamp_micros("start").alias("window_start"),
                F.timestamp_micros(F.col("start") + self.size).alias("window_end"),
                *self.keys, "cnt", "late")
