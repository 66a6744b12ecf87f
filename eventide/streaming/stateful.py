"""Keyed state with event-time timers (``transformWithState``).

``LongIntervalAlerts`` is the START/END alert and ``CountWindowSum`` the count window. Each keeps
a fixed number of values per key and reads a key's rows as an iterator, of which it takes minima,
maxima or sums: no key's rows are gathered. Keys with a handful of rows are the rule, so rows come
as rows and not as frames. State lives in the RocksDB state store
(``spark.sql.streaming.stateStore.providerClass``), partitioned by key across tasks like any
shuffle; checkpoints make it survive restarts and lost executors.

A key costs several calls between Python and the JVM, more than all else where most keys have a
handful of rows once. ``alerts_by_bucket`` (the same alert) and ``pairs_by_bucket`` (the 1:1
pairing of two streams) therefore keep the keys of a bucket, which a hash of the key names, as one
value (``applyInPandasWithState``), and take minima and maxima over all of a bucket's keys at
once. A micro-batch reads and writes the state of the buckets that it touches, and a task holds
one bucket's keys; the number of buckets bounds both and is fixed for a checkpoint's life.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from eventide.operators.windows import duration_micros
from eventide.session import use_rocksdb_state

#: Buckets of keys: 50 million keys are about 25,000 a bucket.
BUCKETS = 2048

ALERT_SCHEMA = T.StructType([
    T.StructField("key", T.LongType()),
    T.StructField("reason", T.StringType()),
    T.StructField("start_ms", T.LongType()),
    T.StructField("end_ms", T.LongType()),
])

_SEEN = T.StructType([
    T.StructField("start_ms", T.LongType()),
    T.StructField("end_ms", T.LongType()),
    T.StructField("done", T.BooleanType()),
    T.StructField("timer_ms", T.LongType()),
])


class LongIntervalAlerts(StatefulProcessor):
    """Input columns: ``key`` (long), ``is_start`` (bool), ``event_ms`` (long epoch ms).

    Either event may come first and either may come again. Of repeated STARTs the earliest
    counts, of repeated ENDs the earliest. When both are known the key is decided: it alerts
    (``too_long``) if the END is more than the limit after the START. A START whose END has not
    come when the watermark passes START + limit alerts (``no_end``). A decided key is remembered
    for ``retention_ms``, so that redelivered events neither alert again nor arm a timer, and is
    then forgotten, as is an END whose START never comes.
    """

    def __init__(self, limit_ms: int, retention_ms: int, report_missing_start: bool = False):
        self.limit_ms = limit_ms
        self.retention_ms = retention_ms
        self.report_missing_start = report_missing_start

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", _SEEN)

    def _row(self, key, reason, start_ms, end_ms) -> Row:
        return Row(key=key, reason=reason, start_ms=start_ms, end_ms=end_ms)

    def _set_timer(self, at: int, before: int | None) -> int:
        if before is not None and before != at:
            self.handle.deleteTimer(before)
        if before != at:
            self.handle.registerTimer(at)
        return at

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        start, end, done, before = self.seen.get() or (None, None, False, None)
        if done:
            return  # decided; whatever comes now is a redelivery
        for r in rows:
            if r.event_ms is None:
                continue
            if r.is_start:
                start = r.event_ms if start is None else min(start, r.event_ms)
            else:
                end = r.event_ms if end is None else min(end, r.event_ms)
        if start is not None and end is not None:
            if end - start > self.limit_ms:
                yield self._row(int(key[0]), "too_long", start, end)
            done, at = True, max(start, end) + self.retention_ms
        elif start is not None:
            at = start + self.limit_ms
        elif end is not None:
            at = end + self.retention_ms
        else:
            return
        self.seen.update((start, end, done, self._set_timer(at, before)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        kept = self.seen.get()
        if kept is None:
            return
        start, end, done, timer = kept
        if expiredTimerInfo.getExpiryTimeInMs() != timer:
            return  # replaced by a later decision
        if start is not None and not done:
            yield self._row(int(key[0]), "no_end", int(start), None)
            at = int(timer) + self.retention_ms
            self.handle.registerTimer(at)
            self.seen.update((start, end, True, at))
            return
        if start is None and self.report_missing_start:
            yield self._row(int(key[0]), "missing_start", None, int(end))
        self.seen.clear()

    def close(self) -> None:
        pass


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("bucket")


_PACKED = T.StructType([T.StructField("rows", T.BinaryType())])


def _keep(state: GroupState, packed: bytes) -> None:
    """Keep a bucket's rows; a bucket without rows is forgotten."""
    if packed:
        state.update((packed,))
    elif state.exists:
        state.remove()


#: Stands for an event that has not come.
_NEVER = np.iinfo(np.int64).max
#: What is kept of a key: its events, whether it is decided, and when its timer fires.
_KEPT = np.dtype([("key", "<i8"), ("start", "<i8"), ("end", "<i8"), ("done", "?"),
                  ("timer", "<i8")])


def _earliest(rows: np.ndarray) -> np.ndarray:
    """One row per key, with the least start and end."""
    if not len(rows):
        return rows
    rows = rows[np.argsort(rows["key"], kind="stable")]
    first = np.flatnonzero(np.concatenate([[True], rows["key"][1:] != rows["key"][:-1]]))
    out = rows[first]
    for name in ("start", "end"):
        out[name] = np.minimum.reduceat(rows[name], first)
    return out


def _alerts(rows: np.ndarray, reason: str) -> pd.DataFrame:
    def at(name: str) -> pd.arrays.IntegerArray:
        return pd.arrays.IntegerArray(rows[name].copy(), rows[name] == _NEVER)
    return pd.DataFrame({"key": rows["key"], "reason": reason, "start_ms": at("start"),
                         "end_ms": at("end")})


def alerts_by_bucket(limit_ms: int, retention_ms: int, report_missing_start: bool) -> Callable:
    """``LongIntervalAlerts`` over all keys of a bucket at once."""
    def run(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        old = np.frombuffer(state.get[0] if state.exists else b"", dtype=_KEPT)
        decided, parts = old[old["done"]], [old[~old["done"]]]
        for rows in frames:
            rows = rows[rows["event_ms"].notna()]
            at, is_start = rows["event_ms"].to_numpy(np.int64), rows["is_start"].to_numpy(bool)
            new = np.zeros(len(rows), dtype=_KEPT)
            new["key"] = rows["key"].to_numpy(np.int64)
            new["start"] = np.where(is_start, at, _NEVER)
            new["end"] = np.where(is_start, _NEVER, at)
            if len(decided):  # what comes for a decided key is a redelivery
                new = new[~np.isin(new["key"], decided["key"])]
            parts.append(_earliest(new))
        now = _earliest(np.concatenate(parts)) if len(parts) > 1 else parts[0].copy()
        started = now["start"] != _NEVER
        both = started & (now["end"] != _NEVER)
        now["done"] = both
        for rows, at, after in ((both, np.maximum(now["start"], now["end"]), retention_ms),
                                (started & ~both, now["start"], limit_ms),
                                (~started, now["end"], retention_ms)):
            now["timer"][rows] = at[rows] + after
        long = now[both]
        long = long[long["end"] - long["start"] > limit_ms]
        if len(long):
            yield _alerts(long, "too_long")
        now = np.concatenate([decided, now])
        watermark = state.getCurrentWatermarkMs()
        due = now["timer"] <= watermark
        alone = due & (now["start"] == _NEVER)
        ended = due & ~alone & ~now["done"]
        if ended.any():
            yield _alerts(now[ended], "no_end")
        if report_missing_start and alone.any():
            yield _alerts(now[alone], "missing_start")
        now["timer"][ended] += retention_ms
        now["done"][ended] = True
        now = now[now["timer"] > watermark]
        _keep(state, now.tobytes())
        if len(now):  # a timeout comes when the watermark is past it, a timer when it is at it
            state.setTimeoutTimestamp(max(1, int(now["timer"].min()) - 1))

    return run


def long_interval_alerts_stream(events: DataFrame, key: str, is_start: str, ts: str,
                                limit: str, delay: str, retention: str,
                                report_missing_start: bool = False,
                                buckets: int | None = None) -> DataFrame:
    """Stream form of the alert. ``ts`` must be a TIMESTAMP column; the watermark is
    ``max(ts) - delay``. Timers fire at micro-batch boundaries once the watermark passes them,
    so a missing-END alert can come one batch after the reference's. ``retention`` is how long
    an END waits for its START, and a decided key is remembered: longer than events are late.
    Events without a key or time belong to no interval and are left out. State and timers are
    kept for every key, or for the keys of each of ``buckets`` buckets: for micro-batches that
    bring many keys."""
    limit_ms = duration_micros(limit) // 1000
    retention_ms = duration_micros(retention) // 1000
    known = events.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    src = known.withWatermark(ts, delay).select(
        F.col(key).cast("long").alias("key"), F.col(is_start).alias("is_start"),
        F.unix_millis(F.col(ts)).alias("event_ms"), F.col(ts).alias("__ts"))
    use_rocksdb_state(events.sparkSession)
    if buckets:
        src = src.withColumn("is_start", F.coalesce("is_start", F.lit(False)))
        return src.select("*", _bucket(buckets)).groupBy("bucket").applyInPandasWithState(
            alerts_by_bucket(limit_ms, retention_ms, report_missing_start), ALERT_SCHEMA, _PACKED,
            "append", GroupStateTimeout.EventTimeTimeout)
    return src.groupBy("key").transformWithState(
        statefulProcessor=LongIntervalAlerts(limit_ms, retention_ms, report_missing_start),
        outputStructType=ALERT_SCHEMA, outputMode="Append", timeMode="EventTime")


# -- 1:1 pairing that consumes on match ------------------------------------------------------

def _last_rows(rows: pd.DataFrame) -> pd.DataFrame:
    """The last row per key and side, by arrival and then by payload."""
    rows = rows[rows["arrival"] == rows.groupby(["key", "side"])["arrival"].transform("max")]
    if rows.duplicated(["key", "side"]).any():
        rows = rows.sort_values("payload").drop_duplicates(["key", "side"], keep="last")
    return rows


def pairs_by_bucket(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Input columns: ``key``, ``side`` (0 or 1), ``arrival`` (long), ``payload`` (JSON text).

    One row per key and side is kept; a row that arrives later replaces an unmatched one of its
    side (rows with the same ``arrival`` are ordered by payload). As soon as both sides are there
    the pair is emitted and both rows are consumed. Rows of one micro-batch count as one arrival
    per side, its last."""
    columns = ["key", "side", "arrival", "payload"]
    parts = [_last_rows(f[columns]) for f in frames]
    rows = _last_rows(pd.concat(parts)) if len(parts) > 1 else parts[0]
    if state.exists:
        waiting = pa.ipc.open_stream(state.get[0]).read_pandas()
        rows = pd.concat([waiting, rows]).drop_duplicates(["key", "side"], keep="last")
    pairs = rows[rows["side"] == 0].merge(rows[rows["side"] == 1], on="key")
    rest = rows[~rows["key"].isin(pairs["key"])]
    packed = pa.BufferOutputStream()
    if len(rest):
        table = pa.Table.from_pandas(rest, preserve_index=False)
        with pa.ipc.new_stream(packed, table.schema) as writer:
            writer.write_table(table)
    _keep(state, packed.getvalue().to_pybytes())
    if len(pairs):
        yield pd.DataFrame({"key": pairs["key"], "left": pairs["payload_x"],
                            "right": pairs["payload_y"]})


def pair_streams(left: DataFrame, right: DataFrame, key: str, l_arrival: str,
                 r_arrival: str, buckets: int = BUCKETS) -> DataFrame:
    """1:1 pairing of two streams on ``key``, whichever side comes first: rows are consumed when
    they meet, a repeated row of one side replaces the one that waits. Returns the key and all
    other columns of both sides (their names must differ). An unmatched row waits for ever, as
    in the reference; the state is one row per side and key, kept by bucket. A row without an
    arrival is before all others of its side."""
    l_cols = [c for c in left.columns if c != key]
    r_cols = [c for c in right.columns if c != key]
    if clash := set(l_cols) & set(r_cols):
        raise ValueError(f"rename one side's {sorted(clash)}")
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
               "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

    def side(df: DataFrame, number: int, arrival: str, cols: list[str]) -> DataFrame:
        # a null key equals none, as in a join
        df = df.where(F.col(key).isNotNull())
        first = F.lit(-(1 << 63)).cast("long")
        return df.select(F.col(key).cast("long").alias("key"), F.lit(number).alias("side"),
                         F.coalesce(F.col(arrival).cast("long"), first).alias("arrival"),
                         F.to_json(F.struct(*cols), options).alias("payload"))

    both = side(left, 0, l_arrival, l_cols).unionByName(side(right, 1, r_arrival, r_cols))
    use_rocksdb_state(left.sparkSession)
    out = T.StructType([T.StructField("key", T.LongType()), T.StructField("left", T.StringType()),
                        T.StructField("right", T.StringType())])
    pairs = both.select("*", _bucket(buckets)).groupBy("bucket").applyInPandasWithState(
        pairs_by_bucket, out, _PACKED, "append", GroupStateTimeout.NoTimeout)
    l_type, r_type = left.select(*l_cols).schema, right.select(*r_cols).schema
    return (pairs.withColumn("__l", F.from_json("left", l_type, options))
                 .withColumn("__r", F.from_json("right", r_type, options))
                 .select(F.col("key").alias(key), "__l.*", "__r.*"))


# -- count windows on a stream ---------------------------------------------------------------

COUNT_WINDOW_SCHEMA = T.StructType([
    T.StructField("window_id", T.LongType()),
    T.StructField("total", T.LongType()),
])


class CountWindowSum(StatefulProcessor):
    """Sum of the values of one window; emitted and forgotten when its ``n`` rows are there."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.part = handle.getValueState("part", T.StructType([
            T.StructField("rows", T.LongType()), T.StructField("total", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        count, total = self.part.get() or (0, 0)
        for r in rows:
            count += 1
            total += r.value or 0
        if count < self.n:
            self.part.update((count, total))
            return
        self.part.clear()
        yield Row(window_id=key[-1], total=total)

    def close(self) -> None:
        pass


def count_window_stream(df: DataFrame, seq: str, value: str, n: int, key: str | None = None,
                        first: int = 0) -> DataFrame:
    """Count windows of ``n`` consecutive rows of a stream whose rows are numbered without gaps
    from ``first`` on in ``seq`` (a log's offsets), per ``key`` if given. A row's window follows
    from its number, so windows are independent: rows may come in any order, windows are spread
    over tasks whatever the key, and the state of a window is two numbers. A trailing window
    that is never filled is never emitted."""
    k = F.col(key) if key else F.lit(0)
    window = F.expr(f"(CAST({seq} AS BIGINT) - {int(first)}) DIV {int(n)}")
    src = df.select(k.alias("__key"), window.alias("__window"),
                    F.col(value).cast("long").alias("value"))
    use_rocksdb_state(df.sparkSession)
    return src.groupBy("__key", "__window").transformWithState(
        statefulProcessor=CountWindowSum(n), outputStructType=COUNT_WINDOW_SCHEMA,
        outputMode="Append", timeMode="None")
