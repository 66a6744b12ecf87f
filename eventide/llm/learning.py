"""Shared by the learned operators: bounded samples, training in one task, model hand-over."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import hash_fraction, id_remainder


def bounded_sample(rows: DataFrame, class_col: str, by: Sequence[str],
                   per_class: int) -> DataFrame:
    """Rows of a labelled frame, about ``per_class`` of each class at most, picked by a hash of
    the columns ``by``, with columns of its own: _weight (how many rows of the class each stands
    for) and _at (the hash, 0..1 within the picked share). Classes are few, so their counts are
    read by the driver."""
    counts = {r[0]: r[1] for r in rows.groupBy(class_col).count().collect()}
    share = F.lit(0.0)
    for label, n in sorted(counts.items(), key=str):
        share = F.when(F.col(class_col) == F.lit(label), min(1.0, per_class / n)).otherwise(share)
    at = hash_fraction(*[F.col(c) for c in by], seed=17)
    return (rows.withColumn("_share", share).withColumn("_h", at).where("_h < _share")
                .withColumn("_weight", F.lit(1.0) / F.nullif(F.col("_share"), F.lit(0.0)))
                .withColumn("_at", F.col("_h") / F.col("_share")).drop("_share", "_h"))


def taught_labels(labels: DataFrame, id_col: str, label_col: str, mod: int,
                  held_out: int) -> DataFrame:
    """doc_id and label of the rows that may be learned from: crc32 of the id modulo ``mod`` is
    not ``held_out``. Null ids and labels are left out; of several labels of an id the largest
    counts."""
    return (labels.select(F.col(id_col).alias("doc_id"),
                          F.col(label_col).cast("int").alias("label"))
                  .where((id_remainder("doc_id", mod) != held_out)
                         & F.col("doc_id").isNotNull() & F.col("label").isNotNull())
                  .groupBy("doc_id").agg(F.max("label").alias("label")))


def train(sample: DataFrame, fit: Callable[[pa.Table], object]) -> object:
    """Fit a model on a bounded sample in one task; its rows come in order of all columns'
    first, so reruns agree. ``fit`` gets one table (perhaps empty) and returns a small model."""
    columns = sample.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        if got:
            model = fit(pa.Table.from_batches(got))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())],
                                             ["model"])

    ordered = sample.repartition(1).sortWithinPartitions(columns[0].name, columns[1].name)
    rows = ordered.mapInArrow(run, "model binary").collect()
    return pickle.loads(rows[0][0]) if rows else None
