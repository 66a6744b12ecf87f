"""Typed feeds over the given tables: the rows that the reference's sources carry, read from
tables, and audits of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import aggs, scan, windows as W
from eventide.plans.registry import bucket_us, query, ts_of
from eventide.plans.windowing import events
from eventide.sources.tables import read_table

S = 1_000_000


def ride_events(spark, d):
    """Ride events: a START per order (order date), an END per line item (ship date); ``part``
    tells the ENDs of a ride apart."""
    starts = read_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("ride_id"), F.lit(True).alias("is_start"),
        F.col("o_orderdate").alias("event_time"), F.lit(0).cast("long").alias("part"))
    ends = read_table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("ride_id"), F.lit(False).alias("is_start"),
        F.col("l_shipdate").alias("event_time"),
        # unique within an order: line number, supplier and part
        ((F.col("l_linenumber").cast("long") * 1_000_000 + F.col("l_suppkey")) * 10_000_000
         + F.col("l_partkey")).alias("part"))
    return starts.unionByName(ends)


_RIDE_EVENTS_SQL = """
SELECT o_orderkey AS ride_id, true AS is_start, o_orderdate AS event_time, CAST(0 AS BIGINT) AS part
FROM orders
UNION ALL
SELECT l_orderkey, false, l_shipdate,
       (CAST(l_linenumber AS BIGINT) * 1000000 + l_suppkey) * 10000000 + l_partkey FROM lineitem"""


@query("ride_events", _RIDE_EVENTS_SQL)
def ride_events_feed(spark, d):
    """The ride feed: START and END events of all rides."""
    return ride_events(spark, d)


@query("ride_starts", f"""
SELECT ride_id, event_time FROM ({_RIDE_EVENTS_SQL}) WHERE is_start""")
def ride_starts(spark, d):
    """The START events of the ride feed (a filter on the flag; the ENDs' scan is pruned)."""
    return ride_events(spark, d).where("is_start").select("ride_id", "event_time")


@query("event_order", f"""
SELECT ride_id, is_start, event_time, part, row_number() OVER (
         ORDER BY event_time, is_start DESC, ride_id, part) - 1 AS pos
FROM ({_RIDE_EVENTS_SQL})""")
def event_order(spark, d):
    """Every ride event with its place in event order: by time, START before END on ties, then
    by ride and part. Places come from quantile pieces, not from one sorted task."""
    rank = F.when(F.col("is_start"), 0).otherwise(1)
    ev = ride_events(spark, d).withColumn("__rank", rank)
    # most ENDs share a whole day with thousands of others: ride ids cut the days further
    tie = (F.col("__rank").cast("long") * F.lit(1 << 52) + F.col("ride_id"))
    return (scan.positions(ev.withColumn("__tie", tie), ["event_time", "__tie", "part"])
                .drop("__rank", "__tie"))


@query("fare_events", """
SELECT l_orderkey AS ride_id, l_shipdate AS start_time,
       CASE WHEN l_linenumber % 2 = 0 THEN 'CASH' ELSE 'CARD' END AS payment_type,
       l_extendedprice * l_tax AS tolls, l_extendedprice AS total_fare
FROM lineitem""")
def fare_events(spark, d):
    """The fare feed: one row per line item."""
    return read_table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("ride_id"), F.col("l_shipdate").alias("start_time"),
        F.when(F.col("l_linenumber") % 2 == 0, "CASH").otherwise("CARD").alias("payment_type"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("tolls"),
        F.col("l_extendedprice").alias("total_fare"))


# Fixed values (must equal the reference): order states.
ORDER_STATUS = {"O": "RECEIVED", "P": "PREPARING", "F": "DELIVERED"}


@query("order_feed", """
SELECT o_orderkey AS order_id, n_name AS city, c_name AS customer,
       CAST(floor(o_totalprice) AS INTEGER) AS amount, o_orderdate AS order_time,
       CASE o_orderstatus WHEN 'O' THEN 'RECEIVED' WHEN 'P' THEN 'PREPARING'
            WHEN 'F' THEN 'DELIVERED' ELSE 'CANCELED' END AS order_status
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def order_feed(spark, d):
    """The order feed: id, place, customer, whole amount, time and state of every order."""
    c = read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("customer"), "c_nationkey")
    n = read_table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"),
                                              F.col("n_name").alias("city"))
    state = F.lit("CANCELED")
    for k, v in ORDER_STATUS.items():
        state = F.when(F.col("o_orderstatus") == k, v).otherwise(state)
    return (read_table(spark, d, "orders").join(c, "o_custkey").join(n, "c_nationkey").select(
        F.col("o_orderkey").alias("order_id"), "city", "customer",
        F.floor("o_totalprice").cast("int").alias("amount"),
        F.col("o_orderdate").alias("order_time"), state.alias("order_status")))


@query("window_completeness", f"""
WITH w AS (SELECT event_type AS page, {bucket_us('ts', 3600 * S)} AS s, count(*) AS cnt
           FROM events GROUP BY 1, 2)
SELECT page, {ts_of('s')} AS window_start, {ts_of(f's + {3600 * S}')} AS window_end, cnt,
       CAST(3 AS BIGINT) AS expected
FROM w WHERE cnt <> 3""")
def window_completeness(spark, d):
    """Audit of the events: (type, hour) windows that do not hold exactly 3 events."""
    w = W.tumble(events(spark, d).select("ts", F.col("event_type").alias("page")), "ts", "1 hour")
    return aggs.completeness_audit(w, ["page", "window_start", "window_end"], 3)
