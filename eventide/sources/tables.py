"""Batch and stream readers for the parquet test tables (and any parquet folder alike)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventide.session import cluster_cores, scratch_path

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst pushes filters and the column list into it."""
    return spark.read.parquet(table_path(sf_dir, name))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin the rows over ``min_partitions`` tasks (default: the cluster's default
    parallelism) when the scan yields at most a quarter of that -- e.g. one file with one row
    group -- so CPU-heavy per-row work (text splitting, JSON codecs, Arrow UDFs) uses all cores.

    A scan with at least a quarter as many partitions as cores is left alone: a full shuffle
    of a large table costs more than the idle cores it would fill. Use it directly on a table
    scan (counting the partitions of a plan that holds a shuffle would run the shuffle).
    """
    want = min_partitions or cluster_cores(df.sparkSession)
    try:
        have = df.rdd.getNumPartitions()
    except Exception:  # no RDD view of this session: leave the plan as it is
        return df
    if have * 4 > want:
        return df
    return df.repartition(want)


def read_table_stream(spark: SparkSession, sf_dir: str, name: str,
                      utc_timestamps: bool = True) -> DataFrame:
    """The same table as an unbounded stream (file source over the parquet path).

    The path may be one file or a folder of part files: it is given as a pattern that matches
    this name alone, which the file source accepts for both. There is no limit on files per
    trigger: a bounded replay reads everything in one micro-batch, so the watermark never
    passes rows that are still in unread files, whatever order the files have.

    Streams need ``TIMESTAMP`` (with zone) for watermarks, while the files hold
    ``TIMESTAMP_NTZ``; with ``utc_timestamps`` every NTZ column is cast (session zone UTC
    keeps the wall-clock value).
    """
    path = table_path(sf_dir, name)
    schema = spark.read.parquet(path).schema
    df = spark.readStream.schema(schema).parquet(
        os.path.join(sf_dir, f"[{name[0]}]{name[1:]}.parquet"))
    return as_utc(df) if utc_timestamps else df


def as_utc(df: DataFrame) -> DataFrame:
    """Cast every TIMESTAMP_NTZ column to TIMESTAMP (same wall clock under a UTC session)."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "timestamp_ntz":
            cols.append(F.col(f.name).cast("timestamp").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def read_lines(spark: SparkSession, path: str, first: int = 0,
               last: int | None = None) -> DataFrame:
    """Lines of a text file, or of a folder of part files in name order, in a column ``line``;
    with bounds, lines ``first`` to ``last`` (from 0, both included; no last: to the end).

    Numbers need the lines' order: a line's place inside its split is its place in the task that
    read it, and every split starts where the lines of all earlier splits end. One row per split
    is summed; the lines themselves are numbered where they stand.
    """
    lines = spark.read.text(path)
    if first <= 0 and last is None:
        return lines.withColumnRenamed("value", "line")
    at = lines.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("__f"),
                      F.col("_metadata.file_block_start").alias("__b"),
                      F.monotonically_increasing_id().alias("__m"))
    kept = scratch_path(spark, "lines")
    at.write.parquet(kept)  # numbers are made once: a second scan may split files differently
    at = spark.read.schema(at.schema).parquet(kept)
    earlier = Window.orderBy("__f", "__b").rowsBetween(Window.unboundedPreceding, -1)
    splits = at.groupBy("__f", "__b").agg(F.min("__m").alias("__m0"),
                                          F.count(F.lit(1)).alias("__n"))
    splits = splits.withColumn("__off", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    number = F.col("__off") + F.col("__m") - F.col("__m0")
    inside = number >= first if last is None else (number >= first) & (number <= last)
    return at.join(splits, ["__f", "__b"]).where(inside).select("line")
