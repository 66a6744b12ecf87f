"""Keyed prefix scans (running aggregates) that stay parallel when one key is huge.

``agg(...).over(Window.partitionBy(key).orderBy(ts))`` sends every row of a key to one task. If
one key holds a third of the data, that task holds a third of the data. ``prefix_scan`` splits
the work in two levels instead:

1. cut the order axis into pieces at global quantiles of the leading order column
   (``approxQuantile`` + a binary-search ``Bucketizer``). A value that fills more than one piece
   by itself is cut again by the next order column, so equal values do not make a large piece;
2. compute the running aggregate inside every (key, piece) -- a window partitioned by key
   and piece, so the pieces of a hot key run in different tasks;
3. aggregate each (key, piece) to one row, run the same aggregate over the earlier pieces
   of the key (one row per piece), and fold that carry into the local values with an
   equi-join on key and piece.

The keys travel as one struct column: a struct is never null and its null fields equal each
other, so windows, summary and join all hash the same two columns and the rows are shuffled once;
the other exchanges carry one row per key and piece. The input is scanned for its row count and
quantiles (the leading order column only), once for the rows and once more for the summary (keys,
order and value columns only).

Pieces are a pure function of the row (its order values), so every branch of the plan sees the
same pieces, also when a stage is recomputed after a lost executor.

Supported kinds are the associative ones: ``count``, ``sum``, ``max``, ``min`` (``max``/``min``
also over structs, which gives arg-max and as-of lookups). Nulls are ignored, as in SQL.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from eventide.session import cluster_cores

_AGG = {"count": F.count, "sum": F.sum, "max": F.max, "min": F.min}
# A piece is one window partition, sorted in one task: pieces are made as many as it takes to
# keep them around this many rows.
ROWS_PER_PIECE = 1_000_000


def default_pieces(df: DataFrame) -> int:
    """Pieces of about ``ROWS_PER_PIECE`` rows, at least two per core of the cluster."""
    return max(2 * cluster_cores(df.sparkSession), -(-df.count() // ROWS_PER_PIECE))


def order_value(df: DataFrame, col: str) -> Column | None:
    """An order column as DOUBLE (timestamps as epoch microseconds: exact below 2^53, i.e. for
    any date of this era), nulls as minus infinity; None if it is no number, date or time."""
    kind = df.schema[col].dataType
    c = F.col(col)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        c = F.unix_micros(c.cast("timestamp"))
    elif isinstance(kind, T.DateType):
        c = F.unix_date(c)
    elif not isinstance(kind, T.NumericType):
        return None
    return F.coalesce(c.cast("double"), F.lit(-math.inf))


def _cut(df: DataFrame, value: Column, only: Column, n: int, name: str):
    """Column ``name``: which of ``n`` quantile ranges of ``value`` (over the rows where ``only``
    holds) a row falls in; and the values that are more than one range wide."""
    tmp = df.withColumn("__ord", value)
    # ranges only need to be roughly equal: a relative error of half of one is enough
    qs = tmp.where(only).approxQuantile("__ord", [i / n for i in range(1, n)],
                                        max(1e-5, 0.5 / n)) if n > 1 else []
    wide = sorted(q for q, times in Counter(qs).items() if times > 1)
    inner = sorted({q for q in qs if math.isfinite(q)})
    if not inner:
        return tmp.withColumn(name, F.lit(0)).drop("__ord"), wide
    out = Bucketizer(splits=[-math.inf, *inner, math.inf], inputCol="__ord",
                     outputCol="__bucket", handleInvalid="keep").transform(tmp)
    return out.withColumn(name, F.col("__bucket").cast("int")).drop("__ord", "__bucket"), wide


def with_pieces(df: DataFrame, order_cols: list[str], n: int | None = None,
                name: str = "__piece") -> DataFrame:
    """Add ``name``: the number of the row's piece, rising with ``order_cols``. Nulls sort first.
    The leading column is cut at ``n - 1`` global quantiles. A value that several quantiles fall
    on is cut again at quantiles of the second column, over the rows that hold such a value; it
    opens its range, so those rows come before the rest of the range. Quantile jobs read one or
    two columns and return at most ``n - 1`` numbers to the driver."""
    n = n or default_pieces(df)
    first = order_value(df, order_cols[0])
    if first is None:
        raise ValueError(f"{order_cols[0]}: the leading order column is a number, date or time")
    out, wide = _cut(df, first, F.lit(True), n, name)
    second = order_value(df, order_cols[1]) if wide and len(order_cols) > 1 else None
    if second is None:
        return out
    inside = first.isin(wide)
    out, _ = _cut(out, second, inside, n, "__sub")
    piece = F.col(name) * F.lit(n + 1) + F.when(inside, F.col("__sub")).otherwise(F.lit(n))
    return out.withColumn(name, piece.cast("long")).drop("__sub")


def as_key(keys: list[str]) -> Column:
    """The key columns as one struct (never null; null fields equal each other)."""
    return F.struct(*[F.col(k) for k in keys])


def _carry_agg(kind: str, c: Column) -> Column:
    # The carry of earlier pieces combines per-piece results: counts add up.
    return F.sum(c) if kind in ("count", "sum") else _AGG[kind](c)


def _combine(kind: str, local: Column, carry: Column) -> Column:
    if kind == "count":
        return F.coalesce(carry, F.lit(0)) + local
    if kind == "sum":
        return F.when(local.isNull(), carry).when(carry.isNull(), local).otherwise(local + carry)
    if kind == "max":
        return F.greatest(local, carry)
    return F.least(local, carry)


def prefix_scan(df: DataFrame, keys: list[str], order_cols: list[str],
                aggs: dict[str, tuple[str, Column]], exclusive: bool = False,
                pieces: int | None = None, piece_col: str | None = None) -> DataFrame:
    """Add one running-aggregate column per ``aggs`` entry ``name -> (kind, value column)``.

    The frame is all earlier rows of the same key in ``order_cols`` order, plus the current row
    unless ``exclusive``. ``order_cols`` must be unique within a key; the first one must be
    numeric, a date or a timestamp (it defines the pieces). ``piece_col`` names a column
    already made by ``with_pieces`` on the same order columns, so chained scans share it.
    """
    names = list(aggs)
    cut = df.withColumnRenamed(piece_col, "__piece") if piece_col else \
        with_pieces(df, order_cols, pieces)
    cut = cut.withColumns({"__key": as_key(keys), **{f"__v_{n}": aggs[n][1] for n in names}})

    upper = -1 if exclusive else Window.currentRow
    w_local = (Window.partitionBy("__key", "__piece").orderBy(*order_cols)
                     .rowsBetween(Window.unboundedPreceding, upper))
    local = cut.select(
        "*", *[_AGG[aggs[n][0]](f"__v_{n}").over(w_local).alias(f"__l_{n}") for n in names])

    stats = cut.groupBy("__key", "__piece").agg(
        *[_AGG[aggs[n][0]](f"__v_{n}").alias(f"__s_{n}") for n in names])
    w_prev = (Window.partitionBy("__key").orderBy("__piece")
                    .rowsBetween(Window.unboundedPreceding, -1))
    carry = stats.select(
        "__key", "__piece",
        *[_carry_agg(aggs[n][0], F.col(f"__s_{n}")).over(w_prev).alias(f"__c_{n}")
          for n in names])

    out = local.join(carry, ["__key", "__piece"])
    for n in names:
        out = out.withColumn(n, _combine(aggs[n][0], F.col(f"__l_{n}"), F.col(f"__c_{n}")))
    out = out.drop("__key", *[f"__{p}_{n}" for n in names for p in ("v", "l", "c")])
    return out.withColumnRenamed("__piece", piece_col) if piece_col else out.drop("__piece")


def positions(df: DataFrame, order_cols: list[str], name: str = "pos",
              pieces: int | None = None) -> DataFrame:
    """Dense 0-based position of every row in ``order_cols`` order (unique tuples), without an
    unpartitioned window: rows are numbered inside their piece, and each piece adds the row
    count of all earlier pieces. The counts table has one row per piece."""
    cut = with_pieces(df, order_cols, pieces)
    local = cut.withColumn("__local", F.row_number().over(
        Window.partitionBy("__piece").orderBy(*order_cols)) - 1)
    counts = cut.groupBy("__piece").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        "__piece",
        F.coalesce(F.sum("__n").over(Window.orderBy("__piece").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    return (local.join(offsets, "__piece")
                 .withColumn(name, F.col("__off") + F.col("__local"))
                 .drop("__piece", "__local", "__off"))
