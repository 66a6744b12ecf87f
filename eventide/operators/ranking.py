"""Deduplication, top-N and ordered limits.

Keep-last / keep-first deduplication first finds each key's position (the largest or smallest
order value), a hash aggregate over keys and one number that is partial before the shuffle, and
then joins the positions back to the rows: no row is sorted or buffered, and a key with a third
of the data sends one number per task. ``latest_per_key`` (change
logs, upsert tables) and top-N use ``row_number() <= n``; Spark turns that into a partial
``WindowGroupLimit`` below the shuffle, so at most ``n`` rows per key and task are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from eventide.operators import windows as W


def _number(df: DataFrame, col: str) -> Column:
    """An integer, date or timestamp column as an exact whole number."""
    kind = df.schema[col].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(col).cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("long")
    if isinstance(kind, T.IntegralType):
        return F.col(col).cast("long")
    raise ValueError(f"{col}: order columns are integers, dates or timestamps")


def position(df: DataFrame, order: list[str]) -> Column:
    """One number that orders rows as one or two columns do, nulls first. Decimals of 38 digits
    are fixed-width in Spark's aggregation buffers, so ``max`` over them is a hash aggregate."""
    if not 1 <= len(order) <= 2:
        raise ValueError("one or two order columns")
    parts = [F.coalesce(_number(df, c), F.lit(-(1 << 62))).cast("decimal(20,0)") for c in order]
    if len(parts) == 1:
        return parts[0].cast("decimal(38,0)")
    # the second number is below 10^19 either way, so steps of 2 * 10^19 keep the first on top
    step = F.lit("20000000000000000000").cast("decimal(20,0)")
    return (parts[0].cast("decimal(38,0)") * step + parts[1]).cast("decimal(38,0)")


def row_hash(df: DataFrame) -> Column:
    """A number from all columns of a row (maps as text: Spark does not hash them)."""
    return F.xxhash64(*[F.to_json(f.name) if "map<" in f.dataType.simpleString()
                        else F.col(f.name) for f in df.schema.fields])


def _pick(df: DataFrame, keys: list[str], order: list[str], last: bool) -> DataFrame:
    """One row per key, as ``ROW_NUMBER() = 1`` gives: of rows with equal positions the one with
    the least hash. Only rows that hold their key's position reach the last shuffle, at most one
    per key and task (the rank filter runs below it as well)."""
    best = (F.max if last else F.min)("__pos").alias("__best")
    rows = df.withColumn("__key", F.struct(*[F.col(k) for k in keys])).withColumn(
        "__pos", position(df, order))
    picked = rows.groupBy("__key").agg(best).withColumnRenamed("__key", "__k")
    same = (F.col("__key") == F.col("__k")) & (F.col("__pos") == F.col("__best"))
    tied = Window.partitionBy("__key").orderBy("__hash")
    return (rows.withColumn("__hash", row_hash(df)).join(picked, same, "left_semi")
                .withColumn("__rn", F.row_number().over(tied)).where("__rn = 1")
                .select(*df.columns))


def latest_per_key(df: DataFrame, keys: list[str], version: str,
                   tie: str | None = None) -> DataFrame:
    """The row with the largest ``version`` per key (then the largest ``tie``, then the least
    hash). Changes of a key are few, so the rows themselves are ranked: at most one per key and
    task is shuffled, once, and a filter on the keys reaches the rows below."""
    order = [version, tie] if tie else [version]
    for c in order:
        _number(df, c)  # refuses other kinds of columns
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order],
                                               "__hash")
    return (df.withColumn("__hash", row_hash(df)).withColumn("__rn", F.row_number().over(newest))
              .where("__rn = 1").select(*df.columns))


def dedup_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the last row per key in ``order`` (``ROW_NUMBER() OVER (... DESC) = 1``): one or two
    integer, date or timestamp columns that are unique within a key. Null keys are one key."""
    return _pick(df, keys, order, last=True)


def dedup_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row per key in ``order``."""
    return _pick(df, keys, order, last=False)


def dedup_last_rows(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``dedup_last`` as one aggregate (``max_by`` of the row): for streams, which cannot join an
    aggregate back to its own rows."""
    cols = [c for c in df.columns]
    row = F.struct(*[F.col(c) for c in cols])
    pick = F.max_by(row, F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(pick).select(*[F.col(f"__row.{c}").alias(c) for c in cols])


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int,
          rank_name: str = "rn") -> DataFrame:
    """The ``n`` first rows per key in ``order`` with their 1-based rank."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_name, F.row_number().over(w)).where(F.col(rank_name) <= n)


def window_top_n(df: DataFrame, ts: str, size: str, key: str, value: Column, n: int,
                 total: str = "total") -> DataFrame:
    """Top ``n`` keys by summed ``value`` inside each tumbling window."""
    per = (W.tumble(df, ts, size).groupBy("window_start", "window_end", key)
             .agg(F.sum(value).alias(total)))
    return top_n(per, ["window_start", "window_end"], [F.col(total).desc(), F.col(key)], n)


def window_dedup(df: DataFrame, ts: str, size: str, keys: list[str], order: list[str],
                 last: bool = False) -> DataFrame:
    """First (or last) row per key inside each tumbling window."""
    win = W.tumble(df, ts, size)
    return _pick(win, ["window_start", "window_end", *keys], order, last=last)


def latest_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """``ORDER BY ... LIMIT n``: Spark plans TakeOrderedAndProject, a per-task top-n heap and a
    merge of ``n`` rows per task, never a full sort. ``n`` of 0 or less means no limit."""
    ordered = df.orderBy(*order)
    return ordered.limit(n) if n > 0 else ordered


def run_rows(df: DataFrame, run_col: str, run: str | None, order: list[Column],
             n: int) -> DataFrame:
    """Rows of one run (an equality filter; a blank or missing run means all runs), stopped after
    ``n`` matches (0 or less: never)."""
    if run is not None and str(run).strip():
        df = df.where(F.col(run_col) == run)
    return latest_rows(df, order, n)
