"""Running (non-windowed) aggregates on streams.

Spark emits one row per key per micro-batch in update mode (``ordered.RunningResults``, and the
batch forms in ``operators.aggs``, emit one output row per input row). The state is one row per key,
which grows with the number of keys: pair these with a watermark-bounded source or accept the
documented unbounded key space of the running count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def running_count_stream(df: DataFrame, keys: list[str], name: str = "running_count") -> DataFrame:
    """Use with ``outputMode("update")``: each batch emits the new totals of its keys."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def running_argmax_stream(df: DataFrame, keys: list[str], value: str, id_col: str) -> DataFrame:
    """Use with ``outputMode("update")``: the best row of each key so far (ties: lowest id)."""
    best = F.max_by(F.struct(F.col(value).alias("best_value"), F.col(id_col).alias("best_id")),
                    F.struct(F.col(value), -F.col(id_col))).alias("__b")
    return df.groupBy(*keys).agg(best).select(*keys, "__b.best_value", "__b.best_id")
