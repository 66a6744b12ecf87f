"""Lookups of a stream against a dimension table that changes meanwhile.

A dimension (such as a database table read over JDBC) is copied to shared storage whenever it is
refreshed, as a numbered version; readers see one version or the next, never a mixture, and a
task that is run again reads the same rows as before. Each micro-batch is joined to the version
in force when it is processed, and its rows are committed together with that version's number: a
batch that comes again after that is already done, one that died before is joined anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators.ranking import row_hash
from eventide.streaming.ordered import BatchLog

#: A version is broadcast up to this size, measured as text when it is published.
BROADCAST_BYTES = 64 << 20


class Dimension(BatchLog):
    """The versions of a table with rows of ``schema``; the ``newest`` ones are kept (a batch has
    to be done before as many more are published, or is run again)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, newest: int = 16):
        super().__init__(spark, path, schema, newest)

    def publish(self, rows: DataFrame) -> int:
        """Copy ``rows`` as the version in force; returns its number. Rows equal to those in
        force (as a bag, by count, size and a sum of hashes) make no new version."""
        last = self.last()
        number = 0 if last is None else last + 1
        name = self._store(rows.select(self.schema.names), f"version-{number}")
        # measured on the copy: the source may have changed again
        copy = self._folders([name])
        size = F.length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
        n, size, mark = copy.agg(
            F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0)),
            F.coalesce(F.sum(row_hash(copy).cast("decimal(38,0)")), F.lit(0)).cast("string")).first()
        note = {"rows": n, "bytes": size, "mark": mark}
        if last is not None and self.note(last) == note:
            self.manifest.remove(f"{self.path}/data", name)
            return last
        at, now = self.manifest.latest()
        kept = [b for b in now["deltas"] if int(b) > number - self.newest]
        self._commit(at, now | {
            "deltas": {b: now["deltas"][b] for b in kept} | {str(number): name},
            "notes": {b: now["notes"][b] for b in kept} | {str(number): note}})
        self._clean()
        return number


class LookupJoin:
    """Left join of a stream's rows (``schema``) to ``dimension`` on the columns ``on``, given to
    ``write``, a ``foreachBatch`` writer. ``refresh``, if given, reads the dimension anew for
    every batch (it gets the batch's number). Null keys match nothing; a key that the dimension
    holds several times gives as many rows."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType,
                 dimension: Dimension, on: list[str],
                 refresh: Callable[[int], DataFrame] | None = None,
                 broadcast_bytes: int = BROADCAST_BYTES):
        self.dimension, self.on, self.refresh = dimension, on, refresh
        self.broadcast_bytes, self.schema = broadcast_bytes, schema
        found = [f for f in dimension.schema.fields if f.name not in on]
        if clash := {f.name for f in found} & set(schema.names):
            raise ValueError(f"rename the dimension's {sorted(clash)}")
        self.joined = BatchLog(spark, f"{path}/joined", T.StructType([*schema.fields, *found]))

    def write(self, batch: DataFrame, batch_id: int) -> None:
        if self.joined.note(batch_id) is not None:
            return
        if self.refresh:
            self.dimension.publish(self.refresh(batch_id))
        version = self.dimension.last()
        if version is None:
            raise RuntimeError("the dimension has no version yet")
        rows = self.dimension.at(version)
        if self.dimension.note(version)["bytes"] <= self.broadcast_bytes:
            rows = F.broadcast(rows)
        self.joined.write(batch.select(self.schema.names).join(rows, self.on, "left"), batch_id,
                          version)

    def versions(self) -> dict[int, int]:
        """The version that each batch was joined to."""
        notes = self.joined.manifest.latest()[1].get("notes", {})
        return {int(b): v for b, v in notes.items()}

    def read(self) -> DataFrame:
        return self.joined.read()
