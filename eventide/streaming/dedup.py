"""Deduplication and ranking on streams.

Spark refuses ``row_number()`` over a stream, so the stream forms are:

* keep-first: ``dropDuplicatesWithinWatermark`` -- the first row of a key is emitted once and
  the key is forgotten when the watermark passes ``delay`` after it (bounded state);
* keep-last: ``max_by`` per key in update mode -- every batch emits the keys whose latest row
  changed; an upsert sink keyed by the same columns keeps the current row;
* window top-N: the windowed aggregate is emitted in append mode (each window once, complete),
  and the ranking runs inside ``foreachBatch`` on that finished window -- an ordinary batch
  ``row_number`` with a partial ``WindowGroupLimit``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.operators import ranking as R
from eventide.streaming.windows import window_agg_stream


def dedup_first_stream(df: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def dedup_last_stream(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Use with ``outputMode("update")``."""
    return R.dedup_last_rows(df, keys, order)


def window_top_n_stream(df: DataFrame, ts: str, delay: str, size: str, key: str,
                        value: Column, n: int, write: Callable[[DataFrame, int], None],
                        total: str = "total"):
    """Returns ``(aggregate stream, foreachBatch function)``: start the stream in append mode
    with the function; it ranks each batch of finished windows and hands the top ``n`` per
    window to ``write(df, batch_id)``."""
    agg = window_agg_stream(df, ts, delay, size, F.sum(value).alias(total), keys=[key])

    def rank(batch: DataFrame, batch_id: int) -> None:
        top = R.top_n(batch, ["window_start", "window_end"],
                      [F.col(total).desc(), F.col(key)], n)
        write(top, batch_id)

    return agg, rank
