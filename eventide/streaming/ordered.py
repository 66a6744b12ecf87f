"""Streams whose state is tables: rows in event order, as-of joins, running results, rankings.

Each class is a ``foreachBatch`` writer. What it remembers between micro-batches is kept in
tables of committed generations (``sinks.UpsertTable`` and ``BatchLog``), and every batch is
computed from the state *before* it, so a batch that died after any step is run again and
replaces what it had written. The work of a batch is DataFrame code: a key with a third of the
rows is cut into pieces (``operators.scan``) or ranked per task first, where keyed state would
hand all its rows to one task.

* ``TemporalJoin`` -- the version in force at each row's time (as-of join of two streams).
* ``RunningResults`` -- one output row per input row, with the aggregate of its key so far.
* ``RankedChanges`` -- the best ``n`` rows per key, as a stream of insertions and retractions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators.joins import asof_join
from eventide.operators.ranking import row_hash, top_n
from eventide.operators.scan import as_key, prefix_scan
from eventide.operators.windows import duration_micros
from eventide.streaming.sinks import UpsertTable


class BatchLog(UpsertTable):
    """The rows that each micro-batch stored, all of them or those of the ``newest`` batches.
    Writing a batch again replaces its rows. A batch may carry a ``note`` (a JSON value), which
    is committed with its rows."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType,
                 newest: int | None = None):
        super().__init__(spark, path, schema, keys=[])
        self.newest = newest

    def write(self, batch: DataFrame, batch_id: int, note=None) -> None:
        name = self._store(batch.select(self.schema.names), f"batch-{batch_id}")
        number, now = self.manifest.latest()
        deltas = now["deltas"] | {str(batch_id): name}
        notes = now.get("notes", {}) | {str(batch_id): note}
        if self.newest:
            old = [b for b in deltas if int(b) <= batch_id - self.newest]
            deltas = {b: v for b, v in deltas.items() if b not in old}
            notes = {b: v for b, v in notes.items() if b not in old}
        self._commit(number, now | {"deltas": deltas, "notes": notes})
        if self.newest or (batch_id + 1) % self.compact_every == 0:
            self._clean()

    def last(self, below: int | None = None) -> int | None:
        """The newest batch there is (before batch ``below``)."""
        ids = [int(b) for b in self.manifest.latest()[1]["deltas"]]
        return max((b for b in ids if below is None or b < below), default=None)

    def note(self, batch_id: int | None):
        return self.manifest.latest()[1].get("notes", {}).get(str(batch_id))

    def at(self, batch_id: int | None) -> DataFrame:
        """The rows that one batch stored."""
        name = self.manifest.latest()[1]["deltas"].get(str(batch_id))
        return self._folders([name] if name else [])

    def read(self) -> DataFrame:
        return self._folders(list(self.manifest.latest()[1]["deltas"].values()))

    def _folders(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(
            *[f"{self.path}/data/{n}" for n in names])


class InEventOrder:
    """Holds rows back until no earlier one can come, then gives them to ``release``.

    The watermark is the latest ``ts`` (a TIMESTAMP column) of all batches less ``delay``: rows
    before it are released, the others wait in a table. A row that comes behind the watermark of
    the batches before cannot be put in order any more and is kept in ``late``. Rows without a
    time wait for nothing and are released with the batch that brought them. ``finish`` ends the
    input: it releases what still waits."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, ts: str, delay: str):
        self.spark, self.ts, self.schema = spark, ts, schema
        self.delay = duration_micros(delay)
        self.waiting = BatchLog(spark, f"{path}/waiting", schema, newest=2)
        self.late = BatchLog(spark, f"{path}/late", schema)

    def release(self, rows: DataFrame, batch_id: int) -> None:
        """Take the rows whose turn has come: none of a later call is earlier (but for rows
        without a time)."""
        raise NotImplementedError

    def write(self, batch: DataFrame, batch_id: int) -> None:
        seen = self.waiting.note(self.waiting.last(batch_id))
        top = batch.agg(F.max(F.unix_micros(self.ts))).first()[0]
        tops = [t for t in (seen, top) if t is not None]
        self._advance(batch, batch_id, None if seen is None else seen - self.delay,
                      max(tops) - self.delay if tops else None, max(tops, default=None))

    def _advance(self, batch: DataFrame, batch_id: int, closed: int | None, upto: int | None,
                 top: int | None) -> None:
        at = F.unix_micros(self.ts)
        behind = F.lit(False) if closed is None else F.coalesce(at < closed, F.lit(False))
        due = at.isNull() if upto is None else at.isNull() | (at < upto)
        held = self.waiting.at(self.waiting.last(batch_id)).unionByName(
            batch.select(self.schema.names).where(~behind))
        if closed is not None:
            self.late.write(batch.where(behind), batch_id)
        self.release(held.where(due), batch_id)
        # last: a batch counts as done when its watermark is committed
        self.waiting.write(held.where(~due), batch_id, top)

    def finish(self, lossless: bool = True) -> None:
        """End of input. Fails if rows were late, unless ``lossless`` is False."""
        last = self.waiting.last()
        if last is not None:
            none = self.spark.createDataFrame([], self.schema)
            self._advance(none, last + 1, None, (1 << 63) - 1, self.waiting.note(last))
        if lossless and not self.late.read().isEmpty():
            raise RuntimeError("rows were later than the watermark")


class TemporalJoin(InEventOrder):
    """Left as-of join of two streams: each left row with the latest version of its key at or
    before the row's time (ties of time: the largest version id), nulls when there is none.

    Feed it ``merge(left, right)``. A left row waits until the watermark has passed it, so
    versions may come in any order within ``delay``. Of the versions behind the watermark only
    the newest of each key is kept. Null keys and versions without a time match nothing; left
    rows without a time come out without a version. ``read`` returns the left columns and the
    version's; their names must differ, but for the key's."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, delay: str):
        super().__init__(spark, path, schema, "at", delay)
        key, at, version = schema["key"], schema["at"], schema["right"]
        self.versions = UpsertTable(spark, f"{path}/versions", T.StructType(
            [key, T.StructField("since", at.dataType), T.StructField("vid", T.LongType()),
             version]), ["key"])
        self.joined = BatchLog(spark, f"{path}/joined", T.StructType([schema["left"], version]))
        self.asked = BatchLog(spark, f"{path}/asked", self.versions.schema, newest=2)

    @staticmethod
    def merge(left: DataFrame, right: DataFrame, key: str, l_ts: str, r_ts: str, l_id: str,
              r_id: str) -> DataFrame:
        """Both streams as one: key, at (TIMESTAMP), id, left or right (the other is null)."""
        l_cols, r_cols = left.columns, [c for c in right.columns if c != key]
        if clash := set(l_cols) & set(r_cols):
            raise ValueError(f"rename one side's {sorted(clash)}")
        l_type = left.select(F.struct(*l_cols)).schema[0].dataType
        r_type = right.select(F.struct(*r_cols)).schema[0].dataType

        def side(df: DataFrame, ts: str, row_id: str, l_row: Column, r_row: Column) -> DataFrame:
            return df.select(F.col(key).alias("key"), F.col(ts).cast("timestamp").alias("at"),
                             F.col(row_id).cast("long").alias("id"), l_row.alias("left"),
                             r_row.alias("right"))

        return side(left, l_ts, l_id, F.struct(*l_cols), F.lit(None).cast(r_type)).unionByName(
            side(right, r_ts, r_id, F.lit(None).cast(l_type), F.struct(*r_cols)))

    def release(self, rows: DataFrame, batch_id: int) -> None:
        left = rows.where(F.col("left").isNotNull()).select("key", "at", "id", "left")
        new = rows.where(F.col("right").isNotNull() & F.col("key").isNotNull()
                         & F.col("at").isNotNull()).select(
            "key", F.col("at").alias("since"), F.col("id").alias("vid"), "right")
        # of the versions of earlier batches, those that a row asks for
        known = self.versions.before(batch_id).join(left.select("key").distinct(), "key",
                                                    "left_semi")
        # stored, as the join reads them several times
        self.asked.write(known.unionByName(new), batch_id)
        timed = asof_join(left.where(F.col("at").isNotNull()), self.asked.at(batch_id), "key",
                          "at", "since", "id", "vid", ["right"])
        no_time = left.where(F.col("at").isNull()).withColumn(
            "right", F.lit(None).cast(self.schema["right"].dataType))
        self.joined.write(timed.select("left", "right").unionByName(
            no_time.select("left", "right")), batch_id)
        newest = new.groupBy("key").agg(F.max(F.struct("since", "vid", "right")).alias("v"))
        self.versions.write(newest.select("key", "v.since", "v.vid", "v.right"), batch_id)

    def read(self) -> DataFrame:
        return self.joined.read().select("left.*", "right.*")


class RunningResults(InEventOrder):
    """Every row with aggregates over the rows of its key so far, itself included, in order of
    ``ts`` and then ``row_id`` (a unique whole number). ``aggs`` maps a name to a kind (``sum``,
    ``max`` or ``min``; a count is a sum of ones) and a column; structs give arg-max.

    The aggregate of each key over released rows is carried to the next batch as one row, which
    opens the key's scan there, so a hot key is scanned in pieces like any other. Null keys are
    one key; rows without a time count as the earliest of the batch that brought them."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, ts: str, delay: str,
                 keys: list[str], row_id: str, aggs: dict[str, tuple[str, Column]]):
        super().__init__(spark, path, schema, ts, delay)
        self.keys, self.row_id, self.aggs = keys, row_id, aggs
        rows = self._valued(spark.createDataFrame([], schema))
        carried = self._carried(rows).schema
        self.carry = UpsertTable(spark, f"{path}/carry", carried, keys)
        self.turn = BatchLog(spark, f"{path}/turn", T.StructType(
            rows.schema.fields + [f for f in carried.fields if f.name not in rows.schema.names]),
            newest=2)
        self.results = BatchLog(spark, f"{path}/results", T.StructType(
            schema.fields + [T.StructField(n, carried[f"__v_{n}"].dataType) for n in aggs]))

    def _valued(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({
            "__side": F.lit(1), "__t": F.unix_micros(self.ts),
            "__id": F.col(self.row_id).cast("long"),
            **{f"__v_{n}": value for n, (_, value) in self.aggs.items()}})

    def _carried(self, rows: DataFrame) -> DataFrame:
        of = {"sum": F.sum, "max": F.max, "min": F.min}
        return rows.groupBy(*self.keys).agg(
            *[of[kind](f"__v_{n}").alias(f"__v_{n}") for n, (kind, _) in self.aggs.items()])

    def release(self, rows: DataFrame, batch_id: int) -> None:
        rows = self._valued(rows)
        touched = rows.select(as_key(self.keys).alias("__key")).distinct()
        carry = self.carry.before(batch_id)
        carry = carry.withColumn("__key", as_key(self.keys)).join(
            touched, "__key", "left_semi").drop("__key").withColumn("__side", F.lit(0))
        # stored, as the scan reads them several times
        self.turn.write(rows.unionByName(carry, allowMissingColumns=True), batch_id)
        both = self.turn.at(batch_id)
        # a carry has no time: it comes first, before rows without a time
        scanned = prefix_scan(both, self.keys, ["__t", "__side", "__id"], {
            n: (kind, F.col(f"__v_{n}")) for n, (kind, _) in self.aggs.items()})
        out = scanned.where("__side = 1").select(
            *self.schema.names,
            *[F.col(n).cast(self.results.schema[n].dataType).alias(n) for n in self.aggs])
        self.results.write(out, batch_id)
        types = self.carry.schema
        self.carry.write(self._carried(both).select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in types.fields]), batch_id)

    def read(self) -> DataFrame:
        return self.results.read()


class RankedChanges:
    """The best ``n`` rows per key of an append-only stream, in ``order``; rows that it leaves
    equal are ordered by a hash. Null keys are one key; columns must be comparable (no maps).

    The state is a table with one row per key and rank, never more than ``n`` per key: a better
    row takes the place of the one it beats, and a place is never empty again. ``changes`` is the
    changelog: ``+I`` (a place taken for the first time), and ``-U`` with ``+U`` (a place whose
    row was retracted, and its new one)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str],
                 order: list[Column], n: int, rank_name: str = "rn"):
        self.schema, self.keys, self.order, self.n, self.rank = schema, keys, order, n, rank_name
        ranked = T.StructType(schema.fields + [T.StructField(rank_name, T.LongType())])
        self.ranked = UpsertTable(spark, f"{path}/ranked", ranked, [*keys, rank_name])
        self.log = BatchLog(spark, f"{path}/changes", T.StructType(
            [T.StructField("op", T.StringType()), *ranked.fields]))

    def write(self, batch: DataFrame, batch_id: int) -> None:
        names = self.schema.names
        batch = batch.select(names)
        touched = batch.select(as_key(self.keys).alias("__key")).distinct()
        held = self.ranked.before(batch_id).withColumn("__key", as_key(self.keys)).join(
            touched, "__key", "left_semi").drop("__key")
        rows = held.select(names).unionByName(batch)
        best = top_n(rows, self.keys, [*self.order, row_hash(batch)], self.n, self.rank)

        def place(df: DataFrame, name: str) -> DataFrame:
            rank = F.col(self.rank).cast("long").alias(self.rank)
            return df.select(F.struct(*self.keys, rank).alias("place"),
                             F.struct(*names).alias(name))

        changed = place(best, "new").join(place(held, "old"), "place", "left").where(
            ~F.col("new").eqNullSafe(F.col("old")))
        rank = F.col("place")[self.rank].alias(self.rank)
        first = F.col("old").isNull()
        events = F.array(
            F.struct(F.when(~first, "-U").alias("op"), F.col("old").alias("row")),
            F.struct(F.when(first, "+I").otherwise("+U").alias("op"), F.col("new").alias("row")))
        log = changed.select(rank, F.explode(events).alias("e")).where(F.col("e.op").isNotNull())
        self.log.write(log.select("e.op", "e.row.*", self.rank), batch_id)
        # the changelog's insertions are what the table takes
        self.ranked.write(self.log.at(batch_id).where("op <> '-U'").drop("op"), batch_id)

    def changes(self) -> DataFrame:
        return self.log.read()

    def read(self) -> DataFrame:
        return self.ranked.read()
