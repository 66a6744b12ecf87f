"""Record codecs and sinks as queries: JSON sources/sinks, quoted-number coercion, replay of a
CSV behaviour log, header decoding, registry-style records with schema evolution, nested
counters, sink-side casts and text rendering."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions import codec as C
from eventide.functions import schemas
from eventide.plans.registry import bucket_us, query, ts_of
from eventide.plans.windowing import EXACT_SQL, events, exact
from eventide.sources.tables import read_lines, read_table, spread
from eventide.streaming.replay import land, record_stream, write_records

S = 1_000_000
#: Counters are whole numbers (BIGINT), amounts in steps of 1e-8: one amount is below 9.2e10.
UNIT = 100_000_000


def wide_events(spark, d):
    """Events spread over all cores before per-row codec work (a no-op on large inputs)."""
    return spread(events(spark, d))


# -- JSON click source / sink ------------------------------------------------------------

def click_json(spark, d, *more: str):
    """Events rendered as click JSON records (``timestamp`` text, ``page``, ``more`` columns)."""
    return wide_events(spark, d).select(
        "event_id",
        C.encode_json(C.click_ts_text("ts").alias("timestamp"),
                      F.col("event_type").alias("page"), *[F.col(c) for c in more])
         .alias("value"))


@query("json_click_source", """
SELECT event_id, event_type AS page, strftime(ts, '%d-%m-%Y %I:%M:%S:%g') AS ts_text,
       date_trunc('millisecond', ts)
         - CASE WHEN hour(ts) >= 12 THEN INTERVAL 12 HOUR ELSE INTERVAL 0 HOUR END AS click_ts
FROM events""")
def json_click_source(spark, d):
    """JSON click records in files, read as a stream and decoded with a fixed schema (FAILFAST:
    a malformed record fails the job, like the typed deserializer). The 12-hour pattern without a marker reads every
    hour as AM, so afternoon times come back 12 h early -- the reference's format."""
    schema = T.StructType([T.StructField("event_id", T.LongType()), *C.CLICK_SCHEMA.fields])
    records = record_stream(click_json(spark, d, "event_id").select("value"), "click-records")
    rec = records.select(C.decode_json("value", schema, failfast=True).alias("r"))
    return land(rec.select("r.event_id", "r.page", F.col("r.timestamp").alias("ts_text"),
                           C.parse_click_ts("r.timestamp").alias("click_ts")), "clicks")


@query("json_click_sink", f"""
SELECT event_type AS page, {ts_of(bucket_us('ts', 15 * S))} AS window_start,
  json_object('windowStart', strftime({ts_of(bucket_us('ts', 15 * S))}, '%d-%m-%Y %I:%M:%S:%g'),
              'windowEnd', strftime({ts_of(bucket_us('ts', 15 * S) + f' + {15 * S}')},
                                    '%d-%m-%Y %I:%M:%S:%g'),
              'page', event_type, 'count', count(*))::VARCHAR AS value
FROM events GROUP BY event_type, {bucket_us('ts', 15 * S)}""")
def json_click_sink(spark, d):
    """15 s click statistics serialised as JSON values for a topic sink."""
    from eventide.plans.windowing import click_count
    stats = click_count(spark, d)
    return stats.select(
        "page", "window_start",
        C.encode_json(C.click_ts_text("window_start").alias("windowStart"),
                      C.click_ts_text("window_end").alias("windowEnd"),
                      F.col("page"), F.col("click_count").alias("count")).alias("value"))


# -- quoted numbers, declared JSON table --------------------------------------------------

@query("json_coerce", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       user_id AS user_id_back
FROM events""")
def json_coerce(spark, d):
    """Numbers in JSON: ``props.k`` is a JSON number; a producer that quotes every number
    (``{"user_id":"8"}``) is read as text and cast, since a numeric schema yields NULL."""
    ev = wide_events(spark, d)
    quoted = C.encode_json(F.col("user_id").cast("string").alias("user_id"))
    props = C.decode_json("props", T.StructType([T.StructField("k", T.LongType())]))
    back = C.decode_json(quoted, T.StructType([T.StructField("user_id", T.StringType())]))
    return ev.select("event_id", props["k"].alias("k"),
                     C.quoted_number(back["user_id"], "bigint").alias("user_id_back"))


BEHAVIOR_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("category_id", T.LongType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
])


def behavior_json(spark, d):
    ev = wide_events(spark, d)
    return ev.select(F.to_json(F.struct(
        F.col("user_id"), F.col("event_id").alias("item_id"),
        (F.col("user_id") % 50 + 1).alias("category_id"),
        F.col("event_type").alias("behavior"), F.col("ts")), C.JSON_TS_OPTIONS).alias("value"))


def json_table(df, value: str, schema: T.StructType, ts: str | None = None, delay: str = "",
               start=None):
    """A declared table over JSON records (a frame or a stream): typed columns plus ``proctime``
    (processing time, one value per micro-batch / query). ``ts`` and ``delay`` declare its
    watermark; ``start`` (a condition on the columns) is where reading begins."""
    rec = df.select(F.from_json(F.col(value), schema, C.JSON_TS_OPTIONS).alias("r")).select("r.*")
    if start is not None:
        rec = rec.where(start)
    rec = rec.withColumn("proctime", F.current_timestamp())
    # a watermark needs TIMESTAMP; under a UTC session the wall clock stays
    return rec.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay) if ts else rec


@query("json_table_source", """
SELECT user_id, event_id AS item_id, user_id % 50 + 1 AS category_id,
       event_type AS behavior, ts, true AS has_proctime
FROM events""")
def json_table_source(spark, d):
    """JSON records in files read as a stream through a declared schema (BIGINT ids, TIMESTAMP
    event time with a 5 s watermark), from the beginning of the log; of the processing time only
    its presence is defined."""
    records = record_stream(behavior_json(spark, d), "behavior-records")
    table = json_table(records, "value", BEHAVIOR_SCHEMA, "ts", "5 seconds", F.col("item_id") >= 0)
    rows = table.withColumn("has_proctime", F.col("proctime").isNotNull()).drop("proctime")
    return land(rows, "behavior").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("user_behavior", """
SELECT user_id, event_id AS item_id, user_id % 50 + 1 AS category_id,
       CASE event_type WHEN 'purchase' THEN 'buy' WHEN 'click' THEN 'cart'
            WHEN 'signup' THEN 'fav' ELSE 'pv' END AS behavior, ts
FROM events""")
def user_behavior(spark, d):
    """The behaviour feed: user, item, category, one of four behaviours, event time."""
    return events(spark, d).select(
        "user_id", F.col("event_id").alias("item_id"),
        (F.col("user_id") % 50 + 1).alias("category_id"), behavior().alias("behavior"), "ts")


# -- behaviour-log replay ------------------------------------------------------------------

BEHAVIOR_NAMES = {"purchase": "buy", "view": "pv", "click": "cart", "signup": "fav",
                  "error": "pv"}
# Fixed value (must equal the reference): the replay JSON line layout, spacing included.
REPLAY_LINE = ('{"user_id": "%s", "item_id":"%s", "category_id": "%s", "behavior": "%s", '
               '"ts": "%s"}')


def behavior():
    """The behaviour an event stands for."""
    return F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v))
                        for k, v in BEHAVIOR_NAMES.items()], F.lit("pv"))


def behavior_csv(spark, d):
    """Events written as the CSV behaviour log ``user,item,category,behavior,epochSeconds``."""
    ev = wide_events(spark, d)
    beh = behavior()
    secs = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / S).cast("long")
    return ev.select(C.csv_line(F.col("user_id"), F.col("event_id"),
                                F.col("user_id") % 50 + 1, beh, secs).alias("line"))


def replay(lines, cycles: int):
    """Replay a CSV log ``cycles`` times (0 or less: not at all): each cycle shifts time by the
    log's span + 1 s, and each line becomes a JSON record with quoted values and zone-shifted
    timestamp text."""
    rows = C.split_csv(lines, "line", ["user_id", "item_id", "category_id", "behavior", "sec"],
                       ["string", "string", "string", "string", "long"])
    # the cycle shift is one number (the log's time span): a global aggregate, read back
    span = rows.agg(((F.max("sec") - F.min("sec")) * 1000 + 1000).alias("shift_ms")).first()
    shift_ms = int(span["shift_ms"]) if span["shift_ms"] is not None else 0
    rounds = F.array(*[F.lit(i) for i in range(cycles)]).cast("array<int>")
    shifted = (rows.withColumn("cycle", F.explode(rounds))
                   .withColumn("ts_ms", F.col("sec") * 1000 + F.col("cycle") * F.lit(shift_ms)))
    return shifted.select(
        "cycle", F.col("item_id").cast("long").alias("item_id"),
        F.format_string(REPLAY_LINE, "user_id", "item_id", "category_id", "behavior",
                        C.replay_ts_text(F.col("ts_ms"))).alias("json"))


@query("replay_behavior_log", f"""
WITH b AS (
  SELECT user_id, event_id, user_id % 50 + 1 AS category_id,
         CASE event_type WHEN 'purchase' THEN 'buy' WHEN 'view' THEN 'pv'
              WHEN 'click' THEN 'cart' WHEN 'signup' THEN 'fav' ELSE 'pv' END AS behavior,
         epoch_us(ts) // {S} AS sec FROM events),
s AS (SELECT (max(sec) - min(sec)) * 1000 + 1000 AS shift_ms FROM b),
c AS (SELECT b.*, cyc AS cycle, sec * 1000 + cyc * s.shift_ms AS ts_ms
      FROM b, s, (SELECT unnest([0, 1]) AS cyc))
SELECT CAST(cycle AS INTEGER) AS cycle, event_id AS item_id,
  printf('{REPLAY_LINE}', CAST(user_id AS VARCHAR), CAST(event_id AS VARCHAR),
         CAST(category_id AS VARCHAR), behavior, strftime(make_timestamp((ts_ms + 8 * 3600 * 1000) * 1000),
                            '%Y-%m-%d %H:%M:%S')) AS json
FROM c""")
def replay_behavior_log(spark, d):
    """Behaviour log in CSV files, read whole -> JSON lines, replayed twice with the time
    shift."""
    folder = write_records(behavior_csv(spark, d), "behavior-log")
    return replay(read_lines(spark, folder), 2)


# -- headers --------------------------------------------------------------------------------

def with_headers(ev):
    """Headers built from event columns: ``trace`` (the props text; clicks add a second
    ``trace`` with the user id, and the last one wins), ``bin`` (two raw bytes of the id);
    error events carry no ``trace``."""
    b1 = F.col("event_id") % 256
    b2 = F.floor(F.col("event_id") / 256) % 256
    two = F.unhex(F.concat(F.lpad(F.hex(b1), 2, "0"), F.lpad(F.hex(b2), 2, "0")))
    h = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    trace1 = h("trace", F.encode(F.col("props"), "UTF-8"))
    trace2 = h("trace", F.encode(F.col("user_id").cast("string"), "UTF-8"))
    binh = h("bin", two)
    headers = (F.when(F.col("event_type") == "error", F.array(binh))
                .when(F.col("event_type") == "click", F.array(trace1, binh, trace2))
                .otherwise(F.array(trace1, binh)))
    return ev.withColumn("headers", headers)


@query("header_decode", """
SELECT event_id,
  CASE WHEN event_type = 'error' THEN '<missing>'
       WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR) ELSE props END AS trace,
  CASE WHEN event_id % 256 BETWEEN 32 AND 126 AND (event_id // 256) % 256 BETWEEN 32 AND 126
       THEN chr(CAST(event_id % 256 AS INTEGER)) || chr(CAST((event_id // 256) % 256 AS INTEGER))
       ELSE '0x' || printf('%02x%02x', event_id % 256, (event_id // 256) % 256) END AS bin
FROM events""")
def header_decode(spark, d):
    """Last header by name rendered as text: ``<missing>``, printable ASCII as is, other
    bytes as ``0x`` + hex."""
    ev = with_headers(wide_events(spark, d))
    return ev.select("event_id", C.header_text("headers", "trace").alias("trace"),
                     C.header_text("headers", "bin").alias("bin"))


# -- registry-style records -----------------------------------------------------------------

# Fixed values (must equal the reference): field names of the sensor and machine records.
SENSOR_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("host", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("event_ts", T.LongType()),
])


def sensor_records(spark, d, run_id: str | None = None):
    """Sensor readings derived from events: key + JSON value (the registry payload)."""
    ev = wide_events(spark, d)
    run = F.lit(run_id) if run_id else F.concat(F.lit("run-"), (F.col("event_id") % 3).cast("string"))
    return ev.select(
        F.col("event_id").alias("offset"),
        F.concat(F.lit("sensor-"), (F.col("user_id") % 10).cast("string")).alias("key"),
        C.encode_json(run.alias("run_id"),
                      F.format_string("evt-%04d", F.col("event_id")).alias("event_id"),
                      F.concat(F.lit("server-"), (F.col("user_id") % 5).cast("string")).alias("host"),
                      F.col("event_type").alias("metric"), F.col("value"),
                      F.unix_millis(F.col("ts").cast("timestamp")).alias("event_ts")).alias("value"))


def new_run_id():
    """A fresh run id for a producer run (random UUID)."""
    return str(uuid.uuid4())


_SENSOR_JSON_SQL = """json_object('run_id', 'run-' || CAST(event_id % 3 AS VARCHAR),
  'event_id', printf('evt-%04d', event_id), 'host', 'server-' || CAST(user_id % 5 AS VARCHAR),
  'metric', event_type, 'value', value, 'event_ts', epoch_us(ts) // 1000)::VARCHAR"""


@query("registry_encode", f"""
SELECT event_id AS offset, 'sensor-' || CAST(user_id % 10 AS VARCHAR) AS key,
       {_SENSOR_JSON_SQL} AS value
FROM events""")
def registry_encode(spark, d):
    """Produce typed sensor records (string key, serialised value)."""
    return sensor_records(spark, d)


@query("registry_decode", """
SELECT 'run-1' AS run_id, printf('evt-%04d', event_id) AS event_id,
       'server-' || CAST(user_id % 5 AS VARCHAR) AS host, event_type AS metric, value,
       epoch_us(ts) // 1000 AS event_ts
FROM events WHERE event_id % 3 = 1 AND event_id % 7 <> 0""")
def registry_decode(spark, d):
    """Consume: decode values (PERMISSIVE), skip payloads that are not records, keep one run."""
    rec = sensor_records(spark, d)
    # every 7th message on the topic is not a record (e.g. a plain string)
    payload = F.when(F.col("offset") % 7 == 0, F.lit("not-a-record")).otherwise(F.col("value"))
    dec = rec.select(C.decode_json(payload, SENSOR_SCHEMA).alias("r"))
    valid = dec.where(F.col("r").isNotNull() & F.col("r.run_id").isNotNull()).select("r.*")
    return valid.where(F.col("run_id") == "run-1")


COUNTER = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("value", T.LongType()),
    T.StructField("unit", T.StringType()),
])
MACHINE_V1 = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("hostname", T.StringType()),
    T.StructField("counters", T.ArrayType(COUNTER)),
])
# Fixed value (must equal the reference): v2 adds os_type with default "UNKNOWN".
MACHINE_V2 = T.StructType(MACHINE_V1.fields + [T.StructField("os_type", T.StringType())])
OS_TYPE_DEFAULT = "UNKNOWN"


def machine_records(spark, d):
    """Machine records from events, v1 for even ids and v2 (with ``os_type``) for odd ids."""
    ev = wide_events(spark, d)
    k = F.get_json_object("props", "$.k").cast("long")
    counters = F.array(
        F.struct(F.lit("amount").alias("name"), (exact() * F.lit(UNIT)).cast("long").alias("value"),
                 F.lit("1e-8").alias("unit")),
        F.struct(F.lit("k").alias("name"), k.alias("value"), F.lit("count").alias("unit")),
        F.struct(F.lit("user").alias("name"), F.col("user_id").alias("value"),
                 F.lit("id").alias("unit")))
    base = [F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
            F.concat(F.lit("host-"), (F.col("user_id") % 20).cast("string")).alias("hostname"),
            counters.alias("counters")]
    os_type = F.when(F.col("user_id") % 2 == 0, F.lit("linux")).otherwise(F.lit("windows"))
    v1 = C.encode_json(*base)
    v2 = C.encode_json(*base, os_type.alias("os_type"))
    return ev.select(F.when(F.col("event_id") % 2 == 0, v1).otherwise(v2).alias("value"))


@query("schema_evolution", """
SELECT epoch_us(ts) // 1000 AS timestamp, 'host-' || CAST(user_id % 20 AS VARCHAR) AS hostname,
  CASE WHEN event_id % 2 = 0 THEN 'UNKNOWN' WHEN user_id % 2 = 0 THEN 'linux' ELSE 'windows' END
    AS os_type
FROM events""")
def schema_evolution(spark, d):
    """Read v1 and v2 records with the v2 reader schema; v1 records get the default."""
    rec = machine_records(spark, d).select(C.decode_json("value", MACHINE_V2).alias("r"))
    return rec.select(F.col("r.timestamp").alias("timestamp"),
                      F.col("r.hostname").alias("hostname"),
                      F.coalesce(F.col("r.os_type"), F.lit(OS_TYPE_DEFAULT)).alias("os_type"))


def machine_schema(version: int) -> schemas.Type:
    """Three versions of the machine record. The second renames ``host``, adds ``os_type``,
    ``load`` and units of counters; the third widens numbers, knows more kinds of events and
    nests the place."""
    # Fixed values (must equal the reference): the second version's os_type and unit defaults.
    counter = [{"name": "name", "type": "string"},
               {"name": "value", "type": "int" if version == 1 else "long"}]
    if version > 1:
        counter.append({"name": "unit", "type": ["string", "null"], "default": "null"})
    fields = [
        {"name": "id", "type": "long"}, {"name": "timestamp", "type": "long"},
        {"name": "host", "type": "string"} if version == 1 else
        {"name": "hostname", "aliases": ["host"], "type": "string"},
        {"name": "counters", "type": {"type": "array", "items": {
            "type": "record", "name": "Counter", "fields": counter}}}]
    if version > 1:
        fields += [
            {"name": "os_type", "type": "string", "default": OS_TYPE_DEFAULT},
            {"name": "load", "type": "float" if version == 2 else "double", "default": -1},
            {"name": "kind", "default": "other", "type": {
                "type": "enum", "name": "Kind", "default": "other",
                "symbols": ["click", "view", "other"] + ["purchase"] * (version > 2)}}]
    if version > 2:
        fields.append({"name": "place", "default": {"rack": 0}, "type": {
            "type": "record", "name": "Place", "fields": [
                {"name": "rack", "type": "long"},
                {"name": "site", "type": ["null", "string"], "default": None}]}})
    return schemas.parse({"type": "record", "name": "MachineData", "fields": fields})


def versioned_records(spark, d):
    """Machine records from events, written with schema version 1, 2 or 3 in turn: lines of the
    version and the JSON record."""
    ev = wide_events(spark, d)
    user, kind = F.col("user_id"), F.col("event_type")

    def counters(unit, size):
        return F.array(F.struct(F.lit("user").alias("name"), (user % 1000).cast(size).alias("value"),
                                *unit)).alias("counters")
    first = [F.col("event_id").alias("id"),
             F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp")]
    host = F.concat(F.lit("host-"), (user % 20).cast("string"))
    os_type = F.when(user % 2 == 0, F.lit("linux")).otherwise(F.lit("windows")).alias("os_type")
    unit = [F.when(user % 3 == 0, F.lit("id")).alias("unit")]
    later = [*first, host.alias("hostname"), counters(unit, "long"), os_type]

    def symbol(*known):
        return F.when(kind.isin(*known), kind).otherwise(F.lit("other")).alias("kind")
    place = F.struct((user % 7).alias("rack"),
                     F.when(user % 2 == 0, F.lit("north")).alias("site")).alias("place")
    bodies = {
        1: C.encode_json(*first, host.alias("host"), counters([], "int")),
        2: C.encode_json(*later, F.col("value").cast("float").alias("load"),
                         symbol("click", "view")),
        3: C.encode_json(*later, F.col("value").alias("load"),
                         symbol("click", "view", "purchase"), place)}
    version = F.col("event_id") % 3 + 1
    body = F.when(version == 1, bodies[1]).when(version == 2, bodies[2]).otherwise(bodies[3])
    return ev.select(F.concat_ws(" ", version.cast("string"), body).alias("value"))


@query("schema_resolution", f"""
SELECT event_id AS id, epoch_us(ts) // 1000 AS timestamp,
  'host-' || CAST(user_id % 20 AS VARCHAR) AS hostname,
  CASE WHEN v = 1 THEN '{OS_TYPE_DEFAULT}' WHEN user_id % 2 = 0 THEN 'linux' ELSE 'windows' END
    AS os_type,
  CASE v WHEN 1 THEN -1.0::DOUBLE WHEN 2 THEN value::FLOAT::DOUBLE ELSE value END AS load,
  CASE WHEN v = 1 THEN 'other' WHEN event_type IN ('click', 'view') THEN event_type
       WHEN v = 3 AND event_type = 'purchase' THEN 'purchase' ELSE 'other' END AS kind,
  CASE WHEN v = 3 THEN user_id % 7 ELSE 0 END AS rack,
  CASE WHEN v = 3 AND user_id % 2 = 0 THEN 'north' END AS site,
  user_id % 1000 AS counter,
  CASE WHEN v = 1 THEN 'null' WHEN user_id % 3 = 0 THEN 'id' END AS unit
FROM (SELECT *, event_id % 3 + 1 AS v FROM events)""")
def schema_resolution(spark, d):
    """Stored records of three schema versions read as a stream and resolved to the third:
    renamed, added, widened and nested fields, optional units, symbols that are not known."""
    lines = record_stream(versioned_records(spark, d), "versioned-records")
    records = lines.select(F.substring_index("value", " ", 1).cast("int").alias("version"),
                           F.expr("substr(value, instr(value, ' ') + 1)").alias("body"))
    read = schemas.read_versions(records, "body", "version",
                                 {v: machine_schema(v) for v in (1, 2, 3)}, machine_schema(3))
    r = read.select("record.*")
    return land(r.select("id", "timestamp", "hostname", "os_type", "load", "kind",
                         F.col("place.rack").alias("rack"), F.col("place.site").alias("site"),
                         F.col("counters")[0]["value"].alias("counter"),
                         F.col("counters")[0]["unit"].alias("unit")), "resolved-records")


@query("explode_counters", f"""
SELECT epoch_us(ts) // 1000 AS timestamp, 'host-' || CAST(user_id % 20 AS VARCHAR) AS hostname,
       'amount' AS name, CAST({EXACT_SQL} * {UNIT} AS BIGINT) AS value, '1e-8' AS unit FROM events
UNION ALL
SELECT epoch_us(ts) // 1000, 'host-' || CAST(user_id % 20 AS VARCHAR), 'k',
       CAST(json_extract_string(props, '$.k') AS BIGINT), 'count' FROM events
UNION ALL
SELECT epoch_us(ts) // 1000, 'host-' || CAST(user_id % 20 AS VARCHAR), 'user', user_id, 'id' FROM events""")
def explode_counters(spark, d):
    """One row per element of the nested ``counters`` array."""
    rec = machine_records(spark, d).select(C.decode_json("value", MACHINE_V2).alias("r"))
    # posexplode_outer keeps the optimizer from re-deriving a size(counters) > 0 filter that
    # would decode every record twice more; the outer row of an empty array has pos NULL
    rows = rec.select("r.timestamp", "r.hostname",
                      F.posexplode_outer("r.counters").alias("pos", "c"))
    return rows.where(F.col("pos").isNotNull()).select(
        "timestamp", "hostname", "c.name", "c.value", "c.unit")


# -- sink-side rows, text --------------------------------------------------------------------

DEMO_SCHEMA = T.StructType([
    T.StructField("Name", T.StringType()),
    T.StructField("Role", T.StringType()),
    T.StructField("Age", T.StringType()),
])


def demo_records(spark, d):
    c = read_table(spark, d, "customer")
    return c.select(C.encode_json(F.col("c_name").alias("Name"),
                                  F.col("c_mktsegment").alias("Role"),
                                  (F.col("c_nationkey") + 18).cast("string").alias("Age"))
                    .alias("value"))


def demo_rows(records):
    """JSON records with a quoted ``Age`` into the ``demo(Name, Role, Age INT)`` row shape."""
    r = records.select(C.decode_json("value", DEMO_SCHEMA).alias("r"))
    return r.select(F.col("r.Name").alias("Name"), F.col("r.Role").alias("Role"),
                    F.col("r.Age").cast("int").alias("Age"))


@query("jdbc_sink_rows", """
SELECT c_name AS "Name", c_mktsegment AS "Role", CAST(c_nationkey + 18 AS INTEGER) AS "Age"
FROM customer""")
def jdbc_sink_rows(spark, d):
    """Rows a JDBC table sink receives: schema from the JSON, ``"23"`` cast to INT."""
    return demo_rows(demo_records(spark, d))


@query("string_concat", """
SELECT o_orderkey,
       'customer.' || CAST(o_custkey AS VARCHAR) || '.' || CAST(CAST(epoch(o_orderdate) AS BIGINT)
         AS VARCHAR) || '@demo.local' AS email
FROM orders""")
def string_concat(spark, d):
    """``CONCAT(name, UNIX_TIMESTAMP(...), '@domain')``: a unique e-mail per row."""
    o = read_table(spark, d, "orders")
    secs = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    return o.select("o_orderkey", F.concat(F.lit("customer."), F.col("o_custkey").cast("string"),
                                           F.lit("."), secs.cast("string"),
                                           F.lit("@demo.local")).alias("email"))


@query("ride_to_csv", """
SELECT event_id,
  CAST(event_id AS VARCHAR) || ',' || CASE WHEN event_id % 2 = 0 THEN 'START' ELSE 'END' END
  || ',' || strftime(ts, '%Y-%m-%dT%H:%M:%S')
  || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN ''
          WHEN epoch_us(ts) % 1000 = 0 THEN printf('.%03d', (epoch_us(ts) % 1000000) // 1000)
          ELSE printf('.%06d', epoch_us(ts) % 1000000) END || 'Z'
  || ',' || CAST(value AS VARCHAR) || ',' || CAST(user_id AS VARCHAR)
  || ',' || CAST(2013000000 + user_id AS VARCHAR) AS line
FROM events""")
def ride_to_csv(spark, d):
    """Ride records rendered as CSV text (``START``/``END`` flag, ISO instant)."""
    ev = wide_events(spark, d)
    return ev.select("event_id", C.csv_line(
        F.col("event_id"), C.flag_text(F.col("event_id") % 2 == 0), C.instant_text("ts"),
        F.col("value"), F.col("user_id"), F.lit(2013000000) + F.col("user_id")).alias("line"))


@query("ddl_views", """
SELECT user_id, event_type AS behavior, ts FROM events WHERE event_type = 'purchase'""")
def ddl_views(spark, d):
    """``CREATE TABLE``-style registration of a source as a session view, then SQL over it."""
    name = f"user_behavior_{uuid.uuid4().hex[:8]}"
    events(spark, d).createOrReplaceTempView(name)
    return spark.sql(f"SELECT user_id, event_type AS behavior, ts FROM {name} "
                     "WHERE event_type = 'purchase'")
