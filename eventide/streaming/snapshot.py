"""The first state of a table whose changes are read from a log: chunks between two positions.

The table is read in ranges of its key while it is being changed. Before a range is read the
log's position is noted (its low fence) and afterwards once more (its high fence); the range was
read at some position between them, which nobody knows. Its rows therefore count as of the low
fence: a change after that, seen by the read or not, writes or removes the whole row again, and
the change with the highest position decides. So neither the table nor the log has to stand
still, and the log is only needed from the first low fence on.

Ranges are fixed when the snapshot begins and committed one by one, rows and fences together, so
a snapshot that died goes on with the first range that is missing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators import cdc
from eventide.operators.ranking import latest_per_key
from eventide.streaming.ordered import BatchLog

#: Rows a chunk holds about.
CHUNK_ROWS = 500_000_000

Range = tuple[int | None, int | None]


def key_ranges(table: DataFrame, key: str, rows_per_chunk: int = CHUNK_ROWS) -> list[Range]:
    """Half-open ranges of the integer column ``key`` that cover all its values with about
    equally many rows each; the first and the last have no bound outwards."""
    chunks = max(1, -(-table.count() // rows_per_chunk))
    cuts = table.approxQuantile(key, [i / chunks for i in range(1, chunks)], 0.1 / chunks)
    edges = [None, *sorted({int(c) for c in cuts}), None]
    return list(zip(edges, edges[1:]))


def in_range(key: str, within: Range) -> F.Column:
    """A filter that reaches the table's scan."""
    low, high = within
    cond = F.lit(True)
    if low is not None:
        cond = cond & (F.col(key) >= low)
    if high is not None:
        cond = cond & (F.col(key) < high)
        if low is None:
            cond = cond | F.col(key).isNull()
    return cond


class Snapshot(BatchLog):
    """Chunks of a table with columns ``image``, kept at ``path``."""

    def __init__(self, spark: SparkSession, path: str, image: T.StructType):
        rows = T.StructType([*image.fields, T.StructField("seq", T.LongType()),
                             T.StructField("at", T.LongType()),
                             T.StructField("deleted", T.BooleanType())])
        super().__init__(spark, path, rows)
        self.image = image

    def take(self, ranges: list[Range], read: Callable[[Range], DataFrame],
             position: Callable[[], int]) -> None:
        """Read the ranges that are not yet here. ``read`` gives a range's current rows,
        ``position`` the log's current position. Of a snapshot begun before, the ranges that it
        began with are taken."""
        number, now = self.manifest.latest()
        if "ranges" not in now:
            self._commit(number, now | {"ranges": ranges})
        for i, within in enumerate(self.ranges()):
            number, now = self.manifest.latest()
            if str(i) in now["deltas"]:
                continue
            low = position()
            rows = read(within).select(
                *self.image.names, F.lit(low).cast("long").alias("seq"),
                cdc.position(F.lit(low), F.lit(cdc.READ)).alias("at"),
                F.lit(False).alias("deleted"))
            name = self._store(rows, f"chunk-{i}")
            high = position()
            if high < low:
                raise ValueError(f"the log's position went back from {low} to {high}")
            notes = now.get("notes", {}) | {str(i): [low, high]}
            self._commit(number, now | {"deltas": now["deltas"] | {str(i): name},
                                        "notes": notes})
        self._clean()

    def ranges(self) -> list[Range]:
        return [tuple(r) for r in self.manifest.latest()[1].get("ranges", [])]

    def fences(self) -> tuple[int, int]:
        """The lowest and the highest position of a complete snapshot: the log is needed from
        after the first, and the table is whole from the second on."""
        now = self.manifest.latest()[1]
        notes = now.get("notes", {})
        missing = [r for i, r in enumerate(now.get("ranges", [])) if str(i) not in notes]
        if missing or not notes:
            raise ValueError(f"the snapshot is not complete: {len(missing)} ranges are missing")
        return min(n[0] for n in notes.values()), max(n[1] for n in notes.values())


def table_at(snapshot: Snapshot, changes: DataFrame, keys: list[str], log_start: int,
             upto: int | None = None) -> DataFrame:
    """The table after the change at ``upto`` (all there are), from a complete snapshot and the
    decoded changes (``cdc.decode_changes``) of a log that is whole after ``log_start``."""
    low, high = snapshot.fences()
    if log_start > low:
        raise ValueError(f"the log is kept after {log_start}, the snapshot began at {low}")
    if upto is not None:
        if upto < high:
            raise ValueError(f"the snapshot holds changes up to {high}, {upto} is before that")
        changes = changes.where(F.col("seq") <= upto)
    rows = snapshot.read().unionByName(changes)
    return latest_per_key(rows, keys, "at").where(~F.col("deleted")).drop("deleted", "at")
