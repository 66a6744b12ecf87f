"""Joins: interval, as-of (temporal), dimension lookup, START/END pairing, anti-join.

Every join is an equi-join Catalyst can plan as a sort-merge or shuffled-hash join (with AQE
skew splitting); none degenerates into a per-key nested loop:

* the interval join adds a time-bucket to the equi-key, so a key only meets rows of its own
  and the neighbouring bucket;
* the as-of join is a keyed prefix scan over the union of both sides (no pairs at all);
* a dimension is broadcast by Spark itself, by its size in bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.operators.scan import prefix_scan
from eventide.operators.windows import duration_micros

def micros(ts: str | Column) -> Column:
    """Epoch microseconds of a TIMESTAMP or TIMESTAMP_NTZ column (session zone is UTC)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


def dim_lookup_join(facts: DataFrame, dim: DataFrame, on: str | list[str],
                    value: str, default: str, name: str) -> DataFrame:
    """Left lookup of ``value`` in a dimension, ``default`` when there is no match. Spark
    broadcasts the dimension by its measured bytes (``autoBroadcastJoinThreshold``, and again at
    run time under AQE) and shuffles a larger one."""
    return (facts.join(dim, on, "left")
                 .withColumn(name, F.coalesce(F.col(value), F.lit(default))))


def signed_micros(duration: str) -> int:
    """``"-6 hours"`` -> -21600000000; ``"0 seconds"`` -> 0."""
    d = duration.strip()
    return -duration_micros(d[1:]) if d.startswith("-") else duration_micros(d)


def interval_join(left: DataFrame, right: DataFrame, key: str, l_ts: str, r_ts: str,
                  lower: str, upper: str) -> DataFrame:
    """Inner join on ``key`` with ``right.ts BETWEEN left.ts + lower AND left.ts + upper``
    (both ends inclusive; offsets are signed durations such as ``"-6 hours"``).

    Both sides get a time bucket of width ``upper - lower``; a left row needs the right buckets
    that cover ``[l + lower, l + upper]`` -- at most two -- so it is exploded into those and the
    join key is ``(key, bucket)``. Every matching pair meets exactly once (a right row has one
    bucket), so no key compares all its rows with each other. Column names of the two sides
    must differ except ``key``.
    """
    lo, hi = signed_micros(lower), signed_micros(upper)
    if hi < lo:
        raise ValueError("upper bound before lower bound")
    width = max(hi - lo, 1)
    lm, rm = micros(l_ts), micros(r_ts)
    first = F.floor((lm + F.lit(lo)) / width).cast("long")
    last = F.floor((lm + F.lit(hi)) / width).cast("long")
    lb = left.withColumn("__bucket", F.explode(F.sequence(first, last)))
    rb = right.withColumn("__bucket", F.floor(rm / width).cast("long"))
    cond = (micros(r_ts) >= micros(l_ts) + F.lit(lo)) & (micros(r_ts) <= micros(l_ts) + F.lit(hi))
    return lb.join(rb, [key, "__bucket"], "inner").where(cond).drop("__bucket")


def asof_join(left: DataFrame, right: DataFrame, key: str, l_ts: str, r_ts: str,
              l_id: str, r_id: str, r_cols: list[str]) -> DataFrame:
    """Left as-of join: each left row gets the ``r_cols`` of the latest right row of the same
    key with ``r_ts <= l_ts`` (nulls when there is none).

    Written as a keyed prefix scan over the union of both sides ordered by time, right rows
    first on equal times: the running ``max`` of ``(r_ts, r_id, r_cols...)`` at a left row is
    its as-of match. Output has the left columns plus ``r_cols``.
    """
    payload_fields = [r_ts, r_id, *[c for c in r_cols if c not in (r_ts, r_id)]]
    l_cols = left.columns
    clash = set(l_cols) & set(r_cols)
    if clash:
        raise ValueError(f"rename the right-side columns {sorted(clash)}: they exist on the left")
    lu = left.select(
        F.col(key).alias("__k"), micros(l_ts).alias("__t"), F.lit(1).alias("__side"),
        F.col(l_id).cast("long").alias("__id"),
        F.struct(*[F.col(c) for c in l_cols]).alias("__left"),
        F.lit(None).cast(right.select(F.struct(*payload_fields)).schema[0].dataType)
         .alias("__right"))
    # a NULL key never equals anything: such right rows can match no left row
    ru = right.where(F.col(key).isNotNull()).select(
        F.col(key).alias("__k"), micros(r_ts).alias("__t"), F.lit(0).alias("__side"),
        F.col(r_id).cast("long").alias("__id"),
        F.lit(None).cast(left.select(F.struct(*l_cols)).schema[0].dataType).alias("__left"),
        F.struct(*payload_fields).alias("__right"))
    both = lu.unionByName(ru)
    scanned = prefix_scan(both, ["__k"], ["__t", "__side", "__id"],
                          {"__match": ("max", F.col("__right"))})
    # NULL-key left rows meet no right row (none were kept), so their match is NULL
    return (scanned.where(F.col("__side") == 1)
                   .select(*[F.col(f"__left.{c}").alias(c) for c in l_cols],
                           *[F.col(f"__match.{c}").alias(c) for c in r_cols]))


def pair_start_end(events: DataFrame, key: str, is_start: Column, ts: str) -> DataFrame:
    """Fold START and END events of one key into ``(key, start_ts, end_ts)``.

    A conditional aggregate, partial before the shuffle: no self-join. The earliest START and
    the earliest END per key are kept.
    """
    return events.groupBy(key).agg(
        F.min(F.when(is_start, F.col(ts))).alias("start_ts"),
        F.min(F.when(~is_start, F.col(ts))).alias("end_ts"))


def long_interval_alerts(pairs: DataFrame, limit: str) -> DataFrame:
    """Batch form of the long-ride alert: a START exists and the END is missing or more than
    ``limit`` later (strictly)."""
    lim = duration_micros(limit)
    return pairs.where(F.col("start_ts").isNotNull() & (
        F.col("end_ts").isNull() |
        (micros("end_ts") - micros("start_ts") > F.lit(lim))))


def missing_events(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``left`` with no partner in ``right`` (left-anti join)."""
    return left.join(right, on, "left_anti")
