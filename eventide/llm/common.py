"""Helpers shared by the text operators: materialised steps, the learning splits, dense slots."""

from __future__ import annotations

import gc
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.session import scratch_path
from eventide.sources.tables import spread

#: Characters that separate words where a contract names them: space and TAB..CR.
WORD = r"[^\x20\x09-\x0D]+"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back. Cuts the
    lineage, so a lost executor re-reads files instead of re-running the stages above."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps. Spark removes them once the driver's garbage
    collector finds that no plan refers to them, which it runs for that purpose only every
    ``spark.cleaner.periodicGC.interval`` (30 minutes): until then an operator of many
    materialised steps holds the files of all of them on the executors' disks."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_or_empty(text_col: str = "text") -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def id_remainder(id_col: str, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % mod


def hash_fraction(*cols: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the given values alone."""
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 30)) / float(1 << 30)


def id_and_text(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """The columns an operator reads, under its own names, so that columns of the caller with
    the same names as an output never clash; a scan of a few row groups is spread over the
    cluster."""
    cols = [F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")]
    return spread(docs.select(*cols, *more))


def doc_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A name for a row by its content, for joining decisions back: id (padded if shorter than 20
    characters, so that names of ids from 0 on sort as they do; a null id sorts last), hash and
    length of the text. Rows that repeat id and text share it."""
    own = F.col(id_col).cast("string")
    written = F.coalesce(F.when(F.length(own) < 20, F.lpad(own, 20, "0")).otherwise(own),
                         F.lit("~"))
    text = text_or_empty(text_col)
    return F.concat_ws(":", written, F.hex(F.xxhash64(text)), F.length(text).cast("string"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Rows that are broadcast at once: a few numbers, or a document's key and some.
BROADCAST_ROWS = 500_000


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` (narrow) rows; otherwise as it is,
    to be joined by a shuffle. Pass a materialised frame: its rows are counted."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def join_split(left: DataFrame, right: DataFrame, key: str, how: str = "inner",
               per: int = 256, counted: DataFrame | None = None) -> DataFrame:
    """``left`` joined with ``right`` (one row per ``key``) on ``key``, where one key may hold a
    large share of the left rows: beyond ``per`` rows a key's rows are dealt to several parts,
    each with a copy of the right row. Only names and part counts of such keys are gathered.
    ``left`` is read twice, so pass a materialised or cheap frame, or in ``counted`` a cheaper
    one with the same keys."""
    hubs = ((counted or left).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > per)
            .select(key, F.ceil(F.col("_n") / per).cast("int").alias("_parts")))
    hubs = materialise(hubs, "hubs")
    if hubs.isEmpty():
        return left.join(right, key, how)
    few = bounded_broadcast(hubs)
    other = [c for c, kind in left.dtypes if c != key and kind in ("bigint", "int")]
    part = F.coalesce(F.pmod(F.xxhash64(*other), F.col("_parts")), F.lit(0)).cast("int")
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    dealt = left.join(few, key, "left").withColumn("_part", part).drop("_parts")
    copied = right.join(few, key, "left").withColumn("_part", F.explode(copies)).drop("_parts")
    return dealt.join(copied, [key, "_part"], how).drop("_part")


def slots_within(df: DataFrame, group: Sequence[str], spread_on: Sequence[str],
                 order: Sequence[str], out: str, buckets: int = 1024) -> DataFrame:
    """Gapless numbers from 0 within each group, without sorting a group in one task.

    Every group is cut into ``buckets`` by a hash of ``spread_on``; rows are numbered inside
    their (group, bucket) and shifted by the row counts of the group's earlier buckets. The
    numbering depends on the values alone; rows equal in ``order`` swap freely.
    ``df`` is read twice, so pass a materialised or cheap frame.
    """
    b = F.pmod(F.xxhash64(*[F.col(c) for c in spread_on]), F.lit(buckets)).cast("int")
    cut = df.withColumn("_b", b)
    keys = [*group, "_b"]
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (cut.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                  .select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return (cut.withColumn("_rn", within).join(offsets, keys)
               .withColumn(out, (F.col("_off") + F.col("_rn")).cast("long"))
               .drop("_b", "_rn", "_off"))
