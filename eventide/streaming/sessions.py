"""Session windows of a stream, with open sessions as state that merges.

Rows of a key less than ``gap`` apart are one session. Rows that fall in one stretch of time of
``gap``'s length are less than that apart, so a micro-batch is first aggregated by key and
stretch, partially before the shuffle: of a key with a third of the rows each task ships one
interval per stretch, never the rows. The intervals of the batch and the open sessions are then
joined up in order of their begins, in pieces of the time axis (``operators.scan``), so no task
holds a key either. Sessions that the watermark has passed are closed and leave the state.

The state is in tables of committed generations, as in ``streaming.ordered``: each batch starts
from the state before it, and a batch that died after any step is run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators.scan import prefix_scan, with_pieces
from eventide.operators.windows import duration_micros
from eventide.streaming.ordered import BatchLog

_MERGE = {"sum": F.sum, "max": F.max, "min": F.min}


class Sessions:
    """Sessions per ``keys`` of the rows given to ``write``, a ``foreachBatch`` writer. ``ts`` is
    a TIMESTAMP column. ``aggs`` maps a name to a kind (``sum``, ``max`` or ``min``; a count is a
    sum of ones) and a column.

    The watermark is the latest time of all earlier batches less ``delay``: rows behind it are
    kept in ``late``, and a session is closed when no later row can be part of it. Null keys are
    one key; rows without a time are in no session."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str],
                 ts: str, gap: str, delay: str, aggs: dict[str, tuple[str, Column]]):
        self.spark, self.schema, self.keys, self.ts, self.aggs = spark, schema, keys, ts, aggs
        self.gap, self.delay = duration_micros(gap), duration_micros(delay)
        none = spark.createDataFrame([], schema)
        first = self._stretches(none).withColumn("__held", F.lit(0))
        self.interval = first.groupBy(*keys, "__start").agg(
            F.max("__end").alias("__end"), *self._partials(F.col)).schema
        self.turn = BatchLog(spark, f"{path}/turn", T.StructType(
            [*self.interval.fields, T.StructField("__held", T.IntegerType())]), newest=2)
        self.merged = BatchLog(spark, f"{path}/merged", self.interval, newest=2)
        self.closed = BatchLog(spark, f"{path}/closed", self.interval)
        self.late = BatchLog(spark, f"{path}/late", schema)

    def _partials(self, value) -> list[Column]:
        return [_MERGE[kind](value(n)).alias(n) for n, (kind, _) in self.aggs.items()]

    def _typed(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                           for f in self.interval.fields])

    def _stretches(self, rows: DataFrame) -> DataFrame:
        t = F.unix_micros(self.ts)
        timed = rows.where(F.col(self.ts).isNotNull())
        return timed.groupBy(*self.keys, F.floor(t / self.gap).alias("__stretch")).agg(
            F.min(t).alias("__start"), F.max(t).alias("__end"),
            *self._partials(lambda n: self.aggs[n][1])).drop("__stretch")

    def _joined_up(self, intervals: DataFrame) -> DataFrame:
        # no two intervals of one batch begin together, and no two open sessions
        order = ["__start", "__held"]
        cut = with_pieces(intervals, order, name="__cut")
        seen = prefix_scan(cut, self.keys, order, {"__before": ("max", F.col("__end"))},
                           exclusive=True, piece_col="__cut")
        opens = F.col("__before").isNull() | (F.col("__start") >= F.col("__before") + self.gap)
        numbered = prefix_scan(seen.withColumn("__opens", opens.cast("long")), self.keys, order,
                               {"__session": ("sum", F.col("__opens"))}, piece_col="__cut")
        return self._typed(numbered.groupBy(*self.keys, "__session").agg(
            F.min("__start").alias("__start"), F.max("__end").alias("__end"),
            *self._partials(F.col)))

    def _over(self, upto: int | None) -> Column:
        return F.lit(False) if upto is None else F.col("__end") + self.gap <= upto

    def write(self, batch: DataFrame, batch_id: int) -> None:
        seen, closed = self.merged.note(self.merged.last(batch_id)) or (None, None)
        top = batch.agg(F.max(F.unix_micros(self.ts))).first()[0]
        top = max((t for t in (seen, top) if t is not None), default=None)
        self._advance(batch, batch_id, closed, None if top is None else top - self.delay, top)

    def _advance(self, batch: DataFrame, batch_id: int, closed: int | None, upto: int | None,
                 top: int | None) -> None:
        batch = batch.select(self.schema.names)
        if closed is not None:
            behind = F.coalesce(F.unix_micros(self.ts) < closed, F.lit(False))
            self.late.write(batch.where(behind), batch_id)
            batch = batch.where(~behind)
        held = self.merged.at(self.merged.last(batch_id)).where(~self._over(closed))
        # stored, as the scans read them several times
        self.turn.write(self._typed(self._stretches(batch)).withColumn("__held", F.lit(0)).unionByName(
            held.withColumn("__held", F.lit(1))), batch_id)
        joined = self._joined_up(self.turn.at(batch_id))
        # the closed ones first: a batch counts as done when its watermark is committed
        self.closed.write(joined.where(self._over(upto)), batch_id)
        self.merged.write(joined.where(~self._over(upto)), batch_id, [top, upto])

    def finish(self, lossless: bool = True) -> None:
        """End of input: closes what is open. Fails if rows were late, unless ``lossless`` is
        False."""
        last = self.merged.last()
        if last is not None:
            top, closed = self.merged.note(last)
            none = self.spark.createDataFrame([], self.schema)
            self._advance(none, last + 1, closed, 1 << 62, top)
        if lossless and not self.late.read().isEmpty():
            raise RuntimeError("rows were later than the watermark")

    def read(self) -> DataFrame:
        """The closed sessions: keys, window_start, window_end and the aggregates."""
        return self.closed.read().select(
            *self.keys, F.timestamp_micros("__start").alias("window_start"),
            F.timestamp_micros(F.col("__end") + self.gap).alias("window_end"), *self.aggs)
