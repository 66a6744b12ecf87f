"""Change-data materialisation: fold row-image change events into the current table.

A change envelope is the JSON record ``{"op", "seq", "before", "after"}``: ``op`` is ``c``
(create), ``r`` (snapshot read), ``u`` (update) or ``d`` (delete); ``seq`` orders changes (log
position); ``before`` and ``after`` are row images, null where there is none. The current table
is, per key, the ``after`` image of the last change unless that change is a delete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions import codec as C
from eventide.operators.ranking import latest_per_key

OPS_DELETE = "d"
#: What decides between rows of one key at one log position: a removal (0) gives way to a row
#: written there (1), and both to a row of the table as it was read at that position (2).
REMOVED, WRITTEN, READ = 0, 1, 2


def envelope(df: DataFrame, op: Column, seq: str, keys: list[str],
             row_cols: list[str]) -> DataFrame:
    """Rows as JSON envelopes in a column ``value``; the ``before`` image of an update or delete
    holds the key columns (the minimal replica identity)."""
    image = F.struct(*[F.col(c) for c in row_cols])
    old = F.struct(*[F.col(c) for c in keys])
    body = F.struct(op.alias("op"), F.col(seq).alias("seq"),
                    F.when(op.isin("c", "r"), F.lit(None)).otherwise(old).alias("before"),
                    F.when(op == OPS_DELETE, F.lit(None)).otherwise(image).alias("after"))
    options = {**C.JSON_TS_OPTIONS, "ignoreNullFields": "false"}
    return df.select(F.to_json(body, options).alias("value"))


def decode(values: DataFrame, value: str, image: T.StructType) -> DataFrame:
    """Envelopes to rows: the image's columns (of a delete, what ``before`` says), ``seq`` and
    ``deleted``. A record that is no envelope fails the job."""
    schema = T.StructType([
        T.StructField("op", T.StringType()), T.StructField("seq", T.LongType()),
        T.StructField("before", image), T.StructField("after", image)])
    rec = values.select(F.from_json(F.col(value), schema,
                                    {**C.JSON_TS_OPTIONS, "mode": "FAILFAST"}).alias("e"))
    gone = F.col("e.op") == OPS_DELETE
    cols = [F.when(gone, F.col(f"e.before.{f.name}")).otherwise(F.col(f"e.after.{f.name}"))
             .alias(f.name) for f in image.fields]
    return rec.select(*cols, F.col("e.seq").alias("seq"), gone.alias("deleted"))


def position(seq: Column, rank: Column) -> Column:
    """Log position and rank as one number; positions are below 2^61."""
    return (seq * 4 + rank).cast("long")


def decode_changes(values: DataFrame, value: str, image: T.StructType,
                   keys: list[str]) -> DataFrame:
    """Envelopes to the image's columns, ``seq``, ``at`` (see ``position``) and ``deleted``, one
    row per key that a change touches: a change of the key itself removes the key of ``before``
    and writes that of ``after``. Records without a value (the tombstones that follow removals in
    a compacted topic) say nothing; a record that is no envelope fails the job."""
    schema = T.StructType([
        T.StructField("op", T.StringType()), T.StructField("seq", T.LongType()),
        T.StructField("before", image), T.StructField("after", image)])
    rec = values.where(F.col(value).isNotNull()).select(
        F.from_json(F.col(value), schema, {**C.JSON_TS_OPTIONS, "mode": "FAILFAST"}).alias("e"))
    gone = F.col("e.op") == OPS_DELETE
    moved = F.lit(False)
    for k in keys:
        moved = moved | ~F.col(f"e.before.{k}").eqNullSafe(F.col(f"e.after.{k}"))
    removes = gone | (F.col("e.before").isNotNull() & moved)
    sides = F.array(F.when(removes, F.struct(F.col("e.before").alias("row"),
                                             F.lit(True).alias("deleted"))),
                    F.when(~gone, F.struct(F.col("e.after").alias("row"),
                                           F.lit(False).alias("deleted"))))
    side = rec.select("e.seq", F.explode(F.array_compact(sides)).alias("side"))
    rank = F.when(F.col("side.deleted"), F.lit(REMOVED)).otherwise(F.lit(WRITTEN))
    return side.select("side.row.*", "seq", position(F.col("seq"), rank).alias("at"),
                       "side.deleted")


def materialize(changes: DataFrame, keys: list[str], seq: str = "seq",
                deleted: str = "deleted") -> DataFrame:
    """Batch form: decoded changes to the current table (without the removed keys)."""
    return latest_per_key(changes, keys, seq).where(~F.col(deleted)).drop(deleted)
