"""Mixing sources to target weights along a time-varying curriculum.

A source's schedule is a piecewise linear weight over training time 0..1. Its integral up to a
time, as a share of the whole, is the demand met by then; a source that has to supply ``target``
words reaches cumulative demand ``d`` at the time where the integral's share is ``d / target``.
Each source is a stream of its documents in hash order, repeated until the target is supplied; an
occurrence's training position is the inverted demand at its middle word. Sorting all occurrences
by position (a range partitioning) gives the training order.

Running word counts inside a source are taken in buckets of the hash order, so one source that
holds a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import WORD, materialise, text_or_empty
from eventide.sources.tables import spread

#: Most passes over a source: no document is taken more than this many times its size.
MAX_REPEATS = 3
#: Buckets of a source's hash order, three hex digits.
BUCKET_DIGITS = 3

#: A schedule: (time, weight) knots with rising times from 0 to 1; the weight is linear between.
Knots = Sequence[tuple[float, float]]
FLAT: Knots = ((0.0, 1.0), (1.0, 1.0))
EARLY: Knots = ((0.0, 2.0), (0.5, 1.0), (1.0, 0.5))
LATE: Knots = ((0.0, 0.5), (0.5, 1.0), (1.0, 2.0))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, max_repeats: int = MAX_REPEATS,
                   weights: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """``sizes`` (source, source_size; one row per source) with its weight and target words.

    Sources by code point, null last, weigh 1, 2, 3, 1, ... and share all words by weight. A
    target stops at ``max_repeats`` times its source's size and the excess is shared again by
    weight until none is above. That fixed point gives source s the smaller of its cap and
    ``L * weight``, with one L for all; sources are capped in order of cap / weight, so L follows
    from running sums in that order. One row per source passes through one task: sources are the
    mixture's own configuration, not data."""
    nth = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source")))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((nth - 1) % len(weights) + 1).cast("int"))
    order = Window.orderBy("_ratio", F.col("source").isNull(), "source")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    ranked = (sizes.withColumn("weight", w)
                   .withColumn("_cap", (F.col("source_size") * max_repeats).cast("double"))
                   .withColumn("_ratio", F.col("_cap") / F.col("weight")))
    # the level if exactly the sources before this one in the order are capped
    level = ((F.sum(F.col("source_size").cast("double")).over(whole)
              - F.coalesce(F.sum("_cap").over(earlier), F.lit(0.0)))
             / (F.sum("weight").over(whole)
                - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))))
    levels = ranked.withColumn("_level", level)
    fits = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_level"))) \
            .over(whole)["_level"]
    return levels.withColumn("_l", fits).select(
        "source", "source_size", "weight",
        F.least(F.col("_cap"), F.coalesce(F.col("_l") * F.col("weight"), F.col("_cap")))
         .alias("target"))


def demand_time(share: Column, knots: Knots) -> Column:
    """The time by which ``share`` (0..1) of a schedule's integral has been demanded."""
    area = [0.0]
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        if t1 <= t0 or min(w0, w1) < 0:
            raise ValueError("knots need rising times and weights of 0 or more")
        area.append(area[-1] + (t1 - t0) * (w0 + w1) / 2)
    if area[-1] <= 0:
        raise ValueError("a schedule needs some weight")
    d = share * area[-1]
    out = F.lit(float(knots[-1][0]))
    for i in range(len(knots) - 2, -1, -1):
        (t0, w0), (t1, w1) = knots[i], knots[i + 1]
        slope, left = (w1 - w0) / (t1 - t0), d - area[i]
        # w0*x + slope*x*x/2 = left, in the form that holds for slope 0 as well
        x = 2 * left / (w0 + F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * left, F.lit(0.0))))
        here = F.when(left <= 0, F.lit(float(t0))).otherwise(
            F.least(F.lit(float(t0)) + x, F.lit(float(t1))))
        out = F.when(d <= area[i + 1], here).otherwise(out)
    return out


def schedule_of(weight: Column) -> list[tuple[Column, Knots]]:
    """The default curriculum: weight 1 early, 2 throughout, 3 late."""
    return [(weight == 1, EARLY), (weight == 3, LATE), (F.lit(True), FLAT)]


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", max_repeats: int = MAX_REPEATS,
        schedules=schedule_of) -> DataFrame:
    """One row per input row: doc_id, size, source, source_size, weight, target, before (words of
    the source ahead of it in hash order), taken (words the mix takes, repeats counted) and
    position (training time of its first occurrence; null if it is not taken).

    A source supplies exactly its target, rounded down to words: whole passes over all its
    documents, then its documents in hash order until the words are met; the last one may be
    taken in part. Nothing is taken beyond ``max_repeats`` times a document's size. The order is
    by md5 of the id (without one: of the text), then id, size and text, so reruns agree;
    identical rows swap freely. Null texts and texts without words have size 0 and are never
    taken; null sources form a source that stands last; an empty table gives no rows; other
    columns are not read.
    """
    slim = materialise(_sized(docs, id_col, text_col, source_col), "mix-sizes")
    taken = _taken(slim, slim, max_repeats)
    return taken.select(
        "doc_id", "size", F.when(~F.col("_none"), F.col("source")).alias("source"),
        "source_size", "weight", "target", "before", "taken",
        F.when(F.col("taken") > 0, _position(F.lit(0), schedules)).alias("position"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", max_repeats: int = MAX_REPEATS,
                    schedules=schedule_of) -> DataFrame:
    """The training sequence: ``docs`` (all columns, whole texts) with a row for each occurrence
    that ``mix`` takes, in whole or in part, range-sorted by its position. The texts are
    shuffled twice: to their place in their source, and to their place in training."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    rows = _sized(docs, id_col, text_col, source_col, whole)
    taken = _taken(rows, rows.drop("_doc"), max_repeats).where("taken > 0")
    last = F.ceil(F.col("taken") / F.col("size")).cast("long") - 1
    placed = (taken.withColumn("_pass", F.explode(F.sequence(F.lit(0).cast("long"), last)))
                   .select(_position(F.col("_pass"), schedules).alias("_at"), "_doc"))
    return (placed.repartitionByRange("_at").sortWithinPartitions("_at").select("_doc.*"))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str,
           *more: Column) -> DataFrame:
    """What placing a row needs: doc_id, _none and source, size, _h (hash order), _b (bucket)."""
    text = text_or_empty(text_col)
    rows = spread(docs).select(
        F.col(id_col).alias("doc_id"), F.col(source_col).isNull().alias("_none"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        word_count(text).alias("size"), F.crc32(text).alias("_crc"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.md5(text))).alias("_h"), *more)
    return rows.withColumn("_b", F.substring("_h", 1, BUCKET_DIGITS))


def _taken(rows: DataFrame, slim: DataFrame, max_repeats: int) -> DataFrame:
    """``rows`` with source_size, weight, target, before and taken; ``slim`` are the same rows
    with few columns."""
    key = ["_none", "source", "_b"]
    per_bucket = slim.groupBy(*key).agg(F.sum("size").alias("_n"))
    ahead = (Window.partitionBy("_none", "source").orderBy("_b")
                   .rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_bucket.withColumn("_off", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
    sizes = per_bucket.groupBy("_none", "source").agg(F.sum("_n").alias("source_size")).select(
        F.when(~F.col("_none"), F.col("source")).alias("source"), "source_size")
    targets = source_targets(sizes, max_repeats).select(
        F.col("source").isNull().alias("_none"),
        F.coalesce("source", F.lit("")).alias("source"), "source_size", "weight", "target")
    # per bucket: what a row needs, so that rows meet it where the window has put them
    per_bucket = materialise(offsets.join(targets, ["_none", "source"]).drop("_n"),
                             "mix-buckets")
    run = (Window.partitionBy(*key).orderBy("_h", "doc_id", "size", "_crc")
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = (rows.withColumn("_run", F.sum("size").over(run)).join(per_bucket, key)
                  .withColumn("before", F.col("_off") + F.col("_run") - F.col("size")))
    words = F.floor("target")
    passes = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))) \
              .otherwise(0).cast("long")
    rest = words - passes * F.col("source_size") - F.col("before")
    taken = passes * F.col("size") + F.least(F.greatest(rest, F.lit(0)), F.col("size"))
    return placed.withColumn("taken", taken.cast("long"))


def _position(nth: Column, schedules) -> Column:
    """Training time of a row's occurrence ``nth`` (from 0), at its middle word."""
    part = F.least(F.col("size"), F.col("taken") - nth * F.col("size"))
    share = (F.col("before") + nth * F.col("source_size") + part / 2) \
        / F.nullif(F.col("target"), F.lit(0.0))
    at = None
    for when, knots in schedules(F.col("weight")):
        time = demand_time(share, knots)
        at = F.when(when, time) if at is None else at.when(when, time)
    return at


def training_order(mixed: DataFrame) -> DataFrame:
    """Mixed rows range-sorted by position: partitions hold consecutive training times and are
    sorted, rows that are not taken come last."""
    return mixed.orderBy(F.col("position").asc_nulls_last(), "doc_id")
