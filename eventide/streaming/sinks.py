"""Stream sinks and a start/restart helper.

* ``UpsertTable`` -- a keyed table on plain files that a stream keeps up to date. Rows live in
  folders that are written once; a manifest names the folders that make up the table. It is
  replaced by one rename after the folders are complete, so readers, retries and compactions see
  either all of a step or nothing of it, whenever a writer dies.
* ``json_value`` -- one JSON text column, the shape a topic sink takes.
* ``start`` / ``run_to_end`` -- ``writeStream`` with a checkpoint folder under the shared
  checkpoint directory; the bounded form reports rows lost to the watermark as an error.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators.ranking import latest_per_key
from eventide.session import scratch_path


def json_value(df: DataFrame, key: str | None = None) -> DataFrame:
    """``value`` = the row as JSON text (and ``key`` as text when given): topic-sink shape."""
    cols = [F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)


class Manifest:
    """Numbered JSON files below ``path``; the largest number holds. A file appears by a rename,
    complete or not at all. One writer at a time (a stream's sink); any number of readers."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.fs = self._path(path).getFileSystem(
            spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self.hadoop.Path("/".join(parts))

    def names(self, folder: str) -> list[str]:
        at = self._path(folder)
        if not self.fs.exists(at):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at))

    def numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.names(self.path) if n.endswith(".json"))

    def read(self, number: int) -> dict:
        stream = self.fs.open(self._path(self.path, f"{number:020d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict]:
        """The current manifest and its number; before the first commit -1 and an empty one."""
        numbers = self.numbers()
        if not numbers:
            return -1, {"base": None, "upto": -1, "deltas": {}}
        return numbers[-1], self.read(numbers[-1])

    def prepare(self, content: dict) -> str:
        """Write ``content`` under a name that no reader looks at."""
        name = f".{uuid.uuid4().hex}.tmp"
        stream = self.fs.create(self._path(self.path, name), True)
        try:
            stream.write(json.dumps(content).encode())
        finally:
            stream.close()
        return name

    def swap(self, name: str, number: int) -> None:
        """Make a prepared file manifest ``number``."""
        final = self._path(self.path, f"{number:020d}.json")
        if self.fs.exists(final) or not self.fs.rename(self._path(self.path, name), final):
            raise RuntimeError(f"{final.toString()}: another writer has committed")

    def remove(self, *parts: str) -> None:
        self.fs.delete(self._path(*parts), True)


class UpsertTable:
    """The upsert table at ``path`` with rows of ``schema``, unique in ``keys``.

    ``version`` names a column that orders the rows of a key (such as a log position); without
    it the later micro-batch wins, and a batch must hold one row per key (as an aggregate in
    update mode does). ``deleted`` names a boolean column that marks a key's removal.

    A micro-batch is a delta; every ``compact_every`` batches the base and all deltas but the
    newest become a new base (the newest batch can still be retried, which replaces its delta).
    Folders that no kept manifest names are removed after the swap; the ``keep`` newest manifests
    are kept, so a reader that began before a compaction still finds its files.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType,
                 keys: Sequence[str], version: str | None = None, deleted: str | None = None,
                 compact_every: int = 16, keep: int = 3):
        self.spark, self.path, self.schema = spark, path, schema
        self.keys, self.version, self.deleted = list(keys), version, deleted
        self.compact_every, self.keep = compact_every, keep
        self.manifest = Manifest(spark, f"{path}/manifest")

    def _done(self, step: str) -> None:
        """Called after every step of a write; tests stop the writer here."""

    def _store(self, rows: DataFrame, kind: str) -> str:
        name = f"{kind}-{uuid.uuid4().hex[:12]}"
        rows.write.parquet(f"{self.path}/data/{name}")
        self._done(f"{kind} stored")
        return name

    def _commit(self, number: int, content: dict) -> None:
        name = self.manifest.prepare(content)
        self._done("manifest prepared")
        self.manifest.swap(name, number + 1)
        self._done("manifest swapped")

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` writer. Writing a batch again replaces it."""
        if self.version:
            batch = latest_per_key(batch, self.keys, self.version)
        name = self._store(batch, f"batch-{batch_id}")
        number, now = self.manifest.latest()
        self._commit(number, now | {"deltas": now["deltas"] | {str(batch_id): name}})
        if (batch_id + 1) % self.compact_every == 0:
            self.compact(batch_id)

    def _rows(self, name: str, batch_id: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/data/{name}").withColumn(
            "__batch", F.lit(batch_id).cast("long"))

    def _folded(self, now: dict, below: int | None = None) -> DataFrame:
        """The newest row of each key, removal markers included, of the base and the deltas of
        the manifest ``now`` (those before batch ``below``)."""
        parts = [self._rows(now["base"], now["upto"])] if now["base"] else []
        parts += [self._rows(name, int(b)) for b, name in now["deltas"].items()
                  if below is None or int(b) < below]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        rows = reduce(DataFrame.unionByName, parts)
        if len(parts) == 1:  # a folder holds one row per key
            return rows.drop("__batch")
        # a batch may hold an older version than the base does
        order = [self.version, "__batch"] if self.version else ["__batch"]
        return latest_per_key(rows, self.keys, *order).drop("__batch")

    def before(self, batch_id: int) -> DataFrame:
        """The newest row of each key, removal markers included, as the table was when batch
        ``batch_id`` came first: what a batch that is run again has to start from."""
        return self._folded(self.manifest.latest()[1], batch_id)

    def compact(self, batch_id: int) -> None:
        """Fold everything before ``batch_id`` into a new base. Removed keys keep their marker,
        so that an older version arriving late stays removed."""
        number, now = self.manifest.latest()
        old = [b for b in now["deltas"] if int(b) < batch_id]
        if old:
            base = self._store(self._folded(now, batch_id), "base")
            left = {b: name for b, name in now["deltas"].items() if b not in old}
            self._commit(number, {"base": base, "upto": max(map(int, old)), "deltas": left})
        self._clean()

    def _clean(self) -> None:
        """Remove old manifests and the folders and unfinished files that none left names."""
        numbers = self.manifest.numbers()
        for n in numbers[:-self.keep]:
            self.manifest.remove(self.manifest.path, f"{n:020d}.json")
            self._done("manifest removed")
        held = [self.manifest.read(n) for n in numbers[-self.keep:]]
        named = {name for m in held for name in [m["base"], *m["deltas"].values()]}
        for name in self.manifest.names(f"{self.path}/data"):
            if name not in named:
                self.manifest.remove(f"{self.path}/data", name)
                self._done("folder removed")
        for name in self.manifest.names(self.manifest.path):
            if name.endswith((".tmp", ".tmp.crc")):
                self.manifest.remove(self.manifest.path, name)

    def read(self) -> DataFrame:
        """The current rows: the newest one of each key that is not removed."""
        rows = self._folded(self.manifest.latest()[1])
        return rows.where(~F.col(self.deleted)) if self.deleted else rows


def jdbc_writer(url: str, table: str, properties: dict[str, str],
                batch_column: str = "batch_id") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer to a JDBC staging table (the driver jar must be on the classpath).
    Every row carries its batch number: a retried batch appends its rows again under the same
    number; ``last_attempt`` reads each batch once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        attempt = uuid.uuid4().hex
        (batch.withColumn(batch_column, F.lit(batch_id)).withColumn("attempt", F.lit(attempt))
              .write.mode("append").jdbc(url, table, properties=properties))
    return write


def last_attempt(staged: DataFrame, batch_column: str = "batch_id") -> DataFrame:
    """A staging table's rows with each batch once: of several attempts the one with most rows
    (an attempt that died has written a part), of equals any."""
    sizes = staged.groupBy(batch_column, "attempt").agg(F.count(F.lit(1)).alias("__n"))
    best = sizes.groupBy(batch_column).agg(F.max_by("attempt", F.struct("__n", "attempt"))
                                            .alias("attempt"))
    return staged.join(best, [batch_column, "attempt"], "left_semi").drop("attempt")


def start(df: DataFrame, name: str, output_mode: str = "append", sink: str = "parquet",
          path: str | None = None, foreach_batch: Callable | None = None,
          trigger: dict | None = None, checkpoint: str | None = None, **options):
    """Start a streaming query with a checkpoint under the shared checkpoint folder.

    Re-using the same ``checkpoint`` path restarts the query where it stopped.
    """
    spark = df.sparkSession
    ck = checkpoint or scratch_path(spark, f"{name}-checkpoint")
    w = df.writeStream.queryName(f"{name}_{abs(hash(ck)) % 10**8}").outputMode(output_mode)
    w = w.option("checkpointLocation", ck)
    for k, v in options.items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).start()
    w = w.format(sink)
    return w.start(path) if path else w.start()


def rows_dropped(query) -> int:
    """Rows a query has discarded as later than its watermark, over its kept progress."""
    return sum(op.numRowsDroppedByWatermark or 0
               for p in query.recentProgress for op in p.stateOperators)


def run_to_end(df: DataFrame, name: str, **options):
    """``start`` over all input there is, and wait. Fails if the watermark dropped a row: a
    bounded replay has to be lossless."""
    q = start(df, name, trigger={"availableNow": True}, **options)
    q.awaitTermination()
    lost = rows_dropped(q)
    if lost:
        raise RuntimeError(f"{name}: {lost} rows were later than the watermark")
    return q
