"""Bounded replays: records written to files and read again as a stream.

A topic's records are text files below the shared checkpoint folder, written by as many tasks as
the table has partitions, so the files are in no particular event order. ``record_stream`` reads
all of them in one micro-batch (see ``sources.tables.read_table_stream``).

``StagedReplay`` admits records in stages, one micro-batch each. ``TimedReplay`` replays in many micro-batches without losing a row: records are staged once by
ranges of event time (ranges hold about equally many rows, as many ranges as keep a batch below a
number of bytes), and a range is admitted to the stream's folder by one rename when the one before
has been processed. All rows of a batch are later than those of the batches before, so a
watermark can close windows and evict state behind it and still never passes an unread row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.session import scratch_path
from eventide.streaming import sinks

#: A micro-batch of a timed replay reads about this much.
BATCH_BYTES = 64 << 30


def write_records(values: DataFrame, name: str, compression: str = "none") -> str:
    """Write a frame of one text column, one record a line; returns the folder."""
    path = scratch_path(values.sparkSession, name)
    values.write.text(path, compression=compression)
    return path


def record_stream(values: DataFrame, name: str) -> DataFrame:
    """The records as a stream with a column ``value``. They are kept compressed, as a topic's
    are: JSON repeats its names in every record. A file is read by the task that takes it."""
    return values.sparkSession.readStream.text(write_records(values, name, "gzip"))


def land(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream without aggregates to its end into a Parquet sink; returns the table."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    sinks.run_to_end(stream, name, path=path)
    return spark.read.schema(stream.schema).parquet(path)


def upserted(stream: DataFrame, name: str, keys: list[str], version: str | None = None,
             deleted: str | None = None, output_mode: str = "update") -> DataFrame:
    """Run a stream to its end into an upsert table; returns the table's current rows."""
    spark = stream.sparkSession
    table = sinks.UpsertTable(spark, scratch_path(spark, name), stream.schema, keys, version,
                              deleted)
    sinks.run_to_end(stream, name, output_mode=output_mode, foreach_batch=table.write)
    return table.read()


class StagedReplay:
    """``records`` as a stream of one micro-batch for each value of the column ``stage`` (INT,
    never null, not part of the stream), in its order; ``newest_first`` turns the order round."""

    def __init__(self, records: DataFrame, stage: str, name: str, newest_first: bool = False):
        self.spark, self.name = records.sparkSession, name
        self.schema = records.drop(stage).schema
        self.folder, staged = scratch_path(self.spark, name), scratch_path(self.spark, name)
        records.withColumnRenamed(stage, "__batch").write.partitionBy("__batch").parquet(staged)
        self.staged = sinks.Manifest(self.spark, staged)
        self.ranges = sorted((n for n in self.staged.names(staged) if n.startswith("__batch=")),
                             key=lambda n: int(n[8:]), reverse=newest_first)
        self.progress: list[dict] = []

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(self.schema).parquet(f"{self.folder}/*")

    def _note(self, query) -> None:
        seen = {p["batch"] for p in self.progress}
        for p in query.recentProgress:
            if p.batchId not in seen:
                self.progress.append({
                    "batch": p.batchId, "rows": p.numInputRows,
                    "watermark": (p.eventTime or {}).get("watermark"),
                    "state": sum(o.numRowsTotal for o in p.stateOperators),
                    "dropped": sum(o.numRowsDroppedByWatermark or 0 for o in p.stateOperators)})

    def run(self, out: DataFrame, foreach_batch: Callable, output_mode: str = "update",
            lossless: bool = True) -> list[dict]:
        """Run the query ``out`` over ``stream()``, range by range. Every batch is accounted for
        (the list returned holds rows, watermark and state of each); a row that the watermark
        dropped fails the run before the next range is admitted."""
        # in update mode nothing waits for a batch without rows: state goes with the next range
        empty, conf = "spark.sql.streaming.noDataMicroBatches.enabled", self.spark.conf
        before = conf.get(empty)
        conf.set(empty, str(output_mode != "update").lower())
        try:
            query = sinks.start(out, self.name, output_mode=output_mode,
                                foreach_batch=foreach_batch)
        finally:
            conf.set(empty, before)
        try:
            for name in self.ranges:
                source = self.staged._path(self.staged.path, name)
                self.staged.fs.mkdirs(self.staged._path(self.folder))
                if not self.staged.fs.rename(source, self.staged._path(self.folder, f"r{name[8:]}")):
                    raise RuntimeError(f"{self.name}: cannot admit {name}")
                query.processAllAvailable()
                self._note(query)
                lost = sum(p["dropped"] for p in self.progress)
                if lossless and lost:
                    raise RuntimeError(f"{self.name}: {lost} rows were later than the watermark")
        finally:
            query.stop()
        return self.progress


class TimedReplay(StagedReplay):
    """``records`` as a stream in order of ``ts`` (a TIMESTAMP column), in at least ``batches``
    micro-batches; ``newest_first`` turns the order of the batches round. Rows without a time
    come with the earliest. ``ts`` itself is part of the stream."""

    def __init__(self, records: DataFrame, ts: str, name: str, batches: int = 5,
                 batch_bytes: int = BATCH_BYTES, newest_first: bool = False):
        size = int(str(records._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        wanted = max(batches, -(-size // batch_bytes) if size < 1 << 60 else batches)
        at = records.select(F.unix_micros(F.col(ts)).cast("double").alias("__at"))
        cuts = at.where("__at is not null").approxQuantile(
            "__at", [i / wanted for i in range(1, wanted)], 0.25 / wanted)
        splits = [-float("inf"), *sorted(set(cuts)), float("inf")]
        if len(splits) > 2:
            ranged = Bucketizer(splits=splits, inputCol="__at", outputCol="__b",
                                handleInvalid="keep").transform(records.withColumn(
                "__at", F.coalesce(F.unix_micros(F.col(ts)).cast("double"), F.lit(splits[1] - 1))))
        else:
            ranged = records.withColumns({"__at": F.lit(0.0), "__b": F.lit(0.0)})
        super().__init__(ranged.drop("__at").withColumn("__b", F.col("__b").cast("int")), "__b",
                         name, newest_first)


def upserted_in_order(records: DataFrame, ts: str, name: str,
                      make: Callable[[DataFrame], DataFrame], keys: list[str],
                      **options) -> DataFrame:
    """``upserted`` over a timed replay: ``make`` turns the stream into the sink's rows."""
    replay = TimedReplay(records, ts, name, **options)
    out = make(replay.stream())
    table = sinks.UpsertTable(replay.spark, scratch_path(replay.spark, name), out.schema, keys)
    replay.run(out, table.write)
    return table.read()
