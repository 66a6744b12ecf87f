"""CDC, changelog upsert and continuous-insert queries: streams into keyed tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions import codec as C
from eventide.operators import cdc
from eventide.plans.registry import bucket_us, query, ts_of
from eventide.plans.windowing import H, _tumble_sql, events
from eventide.session import scratch_path
from eventide.sources.tables import read_table, read_table_stream
from eventide.streaming import sinks
from eventide.streaming.replay import record_stream, upserted
from eventide.streaming.snapshot import Snapshot, in_range, key_ranges
from eventide.streaming.windows import window_agg_stream

D = 86_400_000_000


def change_envelopes(spark, d):
    """JSON change envelopes ``(op, seq, before, after)`` keyed by user, written from events:
    every 10th event deletes the user's row, events 1..3 of each ten create it (``before`` is
    null), the rest update it."""
    ev = events(spark, d)
    r = F.col("event_id") % 10
    op = F.when(r == 0, F.lit("d")).when(r <= 3, F.lit("c")).otherwise(F.lit("u"))
    return cdc.envelope(ev, op, "event_id", ["user_id"], ["user_id", "event_type", "value", "ts"])


@query("cdc_materialize", """
SELECT user_id, event_type, value, ts, event_id AS seq FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1 AND event_id % 10 <> 0""")
def cdc_materialize(spark, d):
    """Row changes read as a stream of JSON envelopes and folded into a compacted table keyed by
    user; the change with the highest position wins, whatever order they arrive in."""
    ev = events(spark, d)
    image = ev.select("user_id", "event_type", "value", "ts").schema
    stream = record_stream(change_envelopes(spark, d), "cdc-envelopes")
    rows = cdc.decode(stream, "value", image)
    table = upserted(rows, "cdc-table", ["user_id"], version="seq", deleted="deleted",
                     output_mode="append")
    return table.select("user_id", "event_type", "value", "ts", "seq")


@query("changelog_upsert", f"""
SELECT user_id, {ts_of(f'max({bucket_us("ts", D)})')} AS last_day, count(*) AS total
FROM events GROUP BY user_id""")
def changelog_upsert(spark, d):
    """An updating result (event count and last day per user) as a stream in update mode, kept
    by an upsert sink keyed by user and read back: the latest update per key."""
    src = read_table_stream(spark, d, "events")
    running = src.groupBy("user_id").agg(F.max(F.window("ts", "1 day").start).alias("last_day"),
                                         F.count(F.lit(1)).alias("total"))
    table = upserted(running, "changelog", ["user_id"])
    return table.select("user_id", F.col("last_day").cast("timestamp_ntz").alias("last_day"),
                        "total")


@query("continuous_insert", _tumble_sql(H))
def continuous_insert(spark, d):
    """``INSERT INTO sink SELECT ...`` as a continuous query: the events table read as a
    stream, 1 h buy counts in update mode, written by an upsert sink under the shared checkpoint
    folder, then read back (runs to the end of the available input)."""
    src = read_table_stream(spark, d, "events")
    buys = src.where(F.col("event_type") == "purchase")
    counts = window_agg_stream(buys, "ts", "1 hour", "1 hour", F.count(F.lit(1)).alias("buy_cnt"))
    table = upserted(counts, "continuous-insert", ["window_start"])
    return table.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                        "buy_cnt")


#: Changes of an order in the log of accounts: step ``i`` stands at ``i * STEP + o_orderkey``.
STEP = 1 << 40


def account_log(spark, d):
    """Change envelopes (``seq``, ``value``) of a table of accounts: an order changes four times,
    the steps of all orders one after the other; a step may remove the account (and the next one
    creates it anew), and every other step also changes its key."""
    steps = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice").withColumn(
        "i", F.explode(F.sequence(F.lit(1), F.lit(4))))

    def account(i):
        return (F.col("o_orderkey") * 8 + F.floor(i / 2)).cast("long").alias("account")

    def removed(i):
        return (F.col("o_orderkey") + i) % 5 == 0
    i = F.col("i")
    gone = removed(i)
    fresh = (i == 1) | removed(i - 1)
    before = F.struct(account(i - 1))
    after = F.struct(account(i), F.col("o_custkey").alias("owner"), i.cast("long").alias("step"),
                     F.col("o_totalprice").alias("amount"))
    op = F.when(gone, F.lit("d")).when(fresh, F.lit("c")).otherwise(F.lit("u"))
    seq = (i * F.lit(STEP) + F.col("o_orderkey")).alias("seq")
    body = F.struct(op.alias("op"), seq,
                    F.when(fresh & ~gone, F.lit(None)).otherwise(before).alias("before"),
                    F.when(gone, F.lit(None)).otherwise(after).alias("after"))
    return steps.select(seq, F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


@query("cdc_snapshot_merge", f"""
SELECT o_orderkey * 8 + 2 AS account, o_custkey AS owner, CAST(4 AS BIGINT) AS step,
       o_totalprice AS amount, 4 * {STEP} + o_orderkey AS seq
FROM orders WHERE (o_orderkey + 4) % 5 <> 0""")
def cdc_snapshot_merge(spark, d):
    """Initial snapshot and change log merged: the table is read in four ranges of its key while
    the log goes on (each range at its own, later position), the log is only kept from the
    snapshot's begin on and is read as a stream into an upsert table that starts with the chunks.
    Changes during a read override what it saw; changed keys leave nothing behind."""
    log = account_log(spark, d)
    image = T.StructType.fromDDL("account long, owner long, step long, amount double")
    top = read_table(spark, d, "orders").agg(F.max("o_orderkey")).first()[0] or 1

    def pos(quarter):  # of a step, from the second one on
        step, rest = divmod(quarter, 4)
        return (2 + step) * STEP + rest * top // 4

    def table(at):
        return cdc.materialize(cdc.decode_changes(log.where(F.col("seq") <= at), "value", image,
                                                  ["account"]), ["account"], "at")
    quarters = iter(range(1, 9))
    snapshot = Snapshot(spark, scratch_path(spark, "accounts-snapshot"), image)
    reads = iter(range(2, 10, 2))
    orders = read_table(spark, d, "orders").select((F.col("o_orderkey") * 8).alias("account"))
    snapshot.take(key_ranges(orders, "account", max(1, -(-orders.count() // 4))),
                  lambda within: table(pos(next(reads)) - top // 8).where(
                      in_range("account", within)),
                  lambda: pos(next(quarters)))
    kept = log.where(F.col("seq") > snapshot.fences()[0]).select("value")
    changes = cdc.decode_changes(record_stream(kept, "accounts-log"), "value", image, ["account"])
    live = sinks.UpsertTable(spark, scratch_path(spark, "accounts"), snapshot.schema, ["account"],
                             version="at", deleted="deleted")
    live.write(snapshot.read(), 0)
    sinks.run_to_end(changes, "accounts",
                     foreach_batch=lambda rows, batch: live.write(rows, batch + 1))
    return live.read().select("account", "owner", "step", "amount", "seq")
