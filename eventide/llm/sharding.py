"""Sharding by a hierarchical weighted hash tree.

Leaves are shards; they stand in racks, racks in regions, and a node weighs what its shards
weigh. A row descends the tree: at each level every child draws a number from the row's key and
the child's name, ``-ln(u) / weight``, and the smallest draw wins. A child then gets rows in
proportion to its weight, and a change of weights moves rows only into children that grew or out
of children that shrank; subtrees whose weights stay keep what they have. A shard opened in a
region of its own takes rows from everywhere and gives none to older shards.

Everything is one expression a row: no shuffle places a row, only slots need one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import id_and_text, materialise, slots_within


@dataclass(frozen=True)
class Shard:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def tree(shards: int, racks: int = 2, per_rack: int = 2) -> list[Shard]:
    """Shards 0..n-1 of equal weight, ``per_rack`` to a rack and ``racks`` to a region."""
    region = racks * per_rack
    return [Shard(s // region, s // per_rack % racks, s) for s in range(shards)]


def grow(layout: Sequence[Shard], weight: float = 1.0) -> list[Shard]:
    """One more shard, in a region of its own: rows move only into it."""
    return [*layout, Shard(max(s.region for s in layout) + 1, 0,
                           max(s.shard for s in layout) + 1, weight)]


def draw(key: Column, name: str, weight: float) -> Column:
    """The child's draw for a row; exponential with rate ``weight``."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(name), key), 11).cast("double") + 0.5) \
        / float(1 << 53)
    return -F.ln(u) / F.lit(float(weight))


def _winner(key: Column, children: list[tuple[int, str, float]]) -> Column:
    if len(children) == 1:
        return F.lit(children[0][0])
    draws = [F.struct(draw(key, name, w).alias("d"), F.lit(c).alias("c"))
             for c, name, w in children]
    return F.least(*draws)["c"]


def place(key: Column, layout: Sequence[Shard]) -> Column:
    """The shard of a key. Rows with a null key share one shard. Shards without weight get
    nothing."""
    live = [s for s in layout if s.weight > 0]
    if not live:
        raise ValueError("a tree needs a shard with weight above 0")

    def kids(level: int, within: tuple) -> list[tuple[int, str, float]]:
        total: dict[int, float] = {}
        for s in live:
            path = (s.region, s.rack, s.shard)
            if path[:level] == within:
                total[path[level]] = total.get(path[level], 0.0) + s.weight
        return [(c, "/".join(map(str, (*within, c))), w) for c, w in sorted(total.items())]

    def descend(level: int, within: tuple) -> Column:
        children = kids(level, within)
        won = _winner(key, children)
        if level == 2:
            return won
        out = descend(level + 1, (*within, children[-1][0]))
        for c, _, _ in children[:-1]:
            out = F.when(won == c, descend(level + 1, (*within, c))).otherwise(out)
        return out

    return descend(0, ())


def assign_shards(docs: DataFrame, layout: Sequence[Shard], id_col: str = "doc_id",
                  out: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row in column ``out`` (replaced if it exists)."""
    return docs.withColumn(out, place(F.col(id_col), layout).cast("int"))


def shard_rows(docs: DataFrame, layout: Sequence[Shard], id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the text's UTF-8 bytes plus 1 (a null text has none), ``slot`` numbers a shard's
    rows from 0 without gaps, by hash of id and text, and ``grown_shard`` is the row's shard once
    ``grow`` has added one. Repeated rows get slots of their own; null ids share one shard (the
    law reads nothing but the id); an empty table gives no rows; a text of any length
    is one row; other columns are not read.
    """
    rows = id_and_text(docs, id_col, text_col)
    slim = materialise(rows.select(
        "doc_id", (F.octet_length("text") + 1).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"), F.lit("key").alias("law"),
        place(F.col("doc_id"), layout).cast("int").alias("shard"),
        place(F.col("doc_id"), grow(layout)).cast("int").alias("grown_shard")), "shards")
    order = ["doc_id", "text_crc32", "size"]
    return slots_within(slim, ["shard"], order, order, "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, layout: Sequence[Shard], path: str,
                 id_col: str = "doc_id") -> None:
    """Write ``docs`` below ``path`` in one folder per shard; tasks write what they hold, so a
    large shard is many files and passes through no single task."""
    assign_shards(docs, layout, id_col).write.partitionBy("shard").parquet(path)
