"""Ride geometry queries. Ride coordinates are derived arithmetically from ``events.event_id``
so both sides of the oracle compute the same DOUBLE inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.functions import geo as G
from eventide.plans.registry import query
from eventide.plans.windowing import events

# SQL text of the DOUBLE coordinates (typed literals: untyped decimals are DECIMAL in SQL).
_DBL = "CAST({} AS DOUBLE)"
SQL_COORDS = (
    f"{_DBL.format(-74.2)} + (event_id % 997) * {_DBL.format(0.0006)} AS start_lon, "
    f"{_DBL.format(40.4)} + (event_id % 991) * {_DBL.format(0.0008)} AS start_lat, "
    f"{_DBL.format(-74.2)} + (event_id % 983) * {_DBL.format(0.0006)} AS end_lon, "
    f"{_DBL.format(40.4)} + (event_id % 977) * {_DBL.format(0.0008)} AS end_lat")


def rides(spark, d):
    """One ride per event: ``(event_id, start_lon, start_lat, end_lon, end_lat)``."""
    e = F.col("event_id")
    return events(spark, d).select(
        "event_id",
        (F.lit(-74.2) + (e % 997) * F.lit(0.0006)).alias("start_lon"),
        (F.lit(40.4) + (e % 991) * F.lit(0.0008)).alias("start_lat"),
        (F.lit(-74.2) + (e % 983) * F.lit(0.0006)).alias("end_lon"),
        (F.lit(40.4) + (e % 977) * F.lit(0.0008)).alias("end_lat"))


def _in_box_sql(lon: str, lat: str) -> str:
    return (f"({lon} <= {_DBL.format(G.LON_EAST)} AND {lon} >= {_DBL.format(G.LON_WEST)} AND "
            f"{lat} <= {_DBL.format(G.LAT_NORTH)} AND {lat} >= {_DBL.format(G.LAT_SOUTH)})")


_CLEAN_SQL = (f"SELECT event_id, {SQL_COORDS} FROM events")


@query("ride_cleansing", f"""
SELECT * FROM ({_CLEAN_SQL})
WHERE {_in_box_sql('start_lon', 'start_lat')} AND {_in_box_sql('end_lon', 'end_lat')}""")
def ride_cleansing(spark, d):
    """Keep rides whose start and end are both inside the NYC box."""
    r = rides(spark, d)
    return r.where(G.is_in_nyc("start_lon", "start_lat") & G.is_in_nyc("end_lon", "end_lat"))


def _cell_sql(lon: str, lat: str) -> str:
    return (f"CAST(floor(({_DBL.format(74.05)} - abs({lon})) / {_DBL.format(G.DELTA_LON)}) AS INTEGER)"
            f" + CAST(floor(({_DBL.format(G.LAT_NORTH)} - {lat}) / {_DBL.format(G.DELTA_LAT)})"
            f" AS INTEGER) * 250")


@query("grid_cell_counts", f"""
SELECT cell_id, count(*) AS cnt,
  CAST(-({_DBL.format(74.05)} - (cell_id % 250) * {_DBL.format(G.DELTA_LON)}
         - {_DBL.format(G.DELTA_LON)} / 2) AS FLOAT) AS center_lon,
  CAST({_DBL.format(G.LAT_NORTH)} - ((cell_id - cell_id % 250) / 250) * {_DBL.format(G.DELTA_LAT)}
       - {_DBL.format(G.DELTA_LAT)} / 2 AS FLOAT) AS center_lat
FROM (SELECT {_cell_sql('start_lon', 'start_lat')} AS cell_id FROM ({_CLEAN_SQL})
      WHERE {_in_box_sql('start_lon', 'start_lat')} AND {_in_box_sql('end_lon', 'end_lat')})
GROUP BY cell_id""")
def grid_cell_counts(spark, d):
    """Ride starts per grid cell (cleansed rides), with the cell centre."""
    clean = ride_cleansing(spark, d)
    cells = clean.select(G.grid_cell("start_lon", "start_lat").alias("cell_id"))
    counts = cells.groupBy("cell_id").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.select("cell_id", "cnt", G.cell_center_lon("cell_id").alias("center_lon"),
                         G.cell_center_lat("cell_id").alias("center_lat"))


@query("ride_distance", f"""
SELECT event_id,
  round({_DBL.format(G.DEG_LEN)} * sqrt((start_lat - end_lat) * (start_lat - end_lat)
        + ((start_lon - end_lon) * cos(end_lat)) * ((start_lon - end_lon) * cos(end_lat))), 10)
    AS distance
FROM ({_CLEAN_SQL})""")
def ride_distance(spark, d):
    """Euclidean ride length in km (degree-based, ``cos`` of degrees as in the reference),
    rounded to 10 decimals: engines' cosines differ in the last bit."""
    r = rides(spark, d)
    dist = G.euclidean_distance("start_lon", "start_lat", "end_lon", "end_lat")
    return r.select("event_id", F.round(dist, 10).alias("distance"))


_FLOATS = ("event_id, CAST(start_lon AS FLOAT) AS a, CAST(start_lat AS FLOAT) AS b, "
           "CAST(end_lon AS FLOAT) AS c, CAST(end_lat AS FLOAT) AS d")


def _distance_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    x, y = f"CAST({lat1} - {lat2} AS DOUBLE)", f"CAST({lon1} - {lon2} AS DOUBLE)"
    y = f"({y} * cos(CAST({lat2} AS DOUBLE)))"
    return f"round({_DBL.format(G.DEG_LEN)} * sqrt({x} * {x} + {y} * {y}), 10)"


def float_rides(spark, d):
    """The rides with FLOAT coordinates, as ride records carry them."""
    r = rides(spark, d)
    return r.select("event_id", *[F.col(c).cast("float").alias(c) for c in r.columns[1:]])


@query("ride_distance_float", f"""
SELECT event_id, {_distance_sql('a', 'b', 'c', 'd')} AS distance
FROM (SELECT {_FLOATS} FROM ({_CLEAN_SQL}))""")
def ride_distance_float(spark, d):
    """Ride length of FLOAT coordinates: differences in FLOAT, the rest in DOUBLE."""
    dist = G.euclidean_distance("start_lon", "start_lat", "end_lon", "end_lat")
    return float_rides(spark, d).select("event_id", F.round(dist, 10).alias("distance"))


@query("distance_to_point", f"""
SELECT event_id, event_id % 2 = 0 AS is_start,
  CASE WHEN event_id % 2 = 0
       THEN {_distance_sql('a', 'b', 'CAST(-73.9 AS FLOAT)', 'CAST(40.75 AS FLOAT)')}
       ELSE {_distance_sql('c', 'd', 'CAST(-73.9 AS FLOAT)', 'CAST(40.75 AS FLOAT)')} END
    AS distance
FROM (SELECT {_FLOATS} FROM ({_CLEAN_SQL}))""")
def distance_to_point(spark, d):
    """Distance of each ride event to a fixed point: from the start of a START event (even
    ids), from the end of an END event."""
    start = F.col("event_id") % 2 == 0
    lon, lat = F.lit(-73.9).cast("float"), F.lit(40.75).cast("float")
    dist = G.distance_to_point(start, "start_lon", "start_lat", "end_lon", "end_lat", lon, lat)
    return float_rides(spark, d).select("event_id", start.alias("is_start"),
                                        F.round(dist, 10).alias("distance"))


@query("ride_direction", f"""
SELECT event_id,
  CAST(trunc(degrees(atan2(end_lat - start_lat,
                           CASE WHEN w = 0 THEN 0 ELSE w END))) AS INTEGER) + 179 AS angle
FROM (SELECT *, (end_lon - start_lon) * cos(start_lat) AS w FROM ({_CLEAN_SQL}))""")
def ride_direction(spark, d):
    """Direction angle 0..359 of every ride; coincident start and end points have 179."""
    return rides(spark, d).select(
        "event_id", G.direction_angle("start_lon", "start_lat", "end_lon", "end_lat")
        .alias("angle"))


_ROUTE_CELLS_SQL = f"""
WITH g AS (
  SELECT event_id,
    CAST(floor(({_DBL.format(74.05)} - abs(start_lon)) / {_DBL.format(G.DELTA_LON)}) AS BIGINT) xa,
    CAST(floor(({_DBL.format(G.LAT_NORTH)} - start_lat) / {_DBL.format(G.DELTA_LAT)}) AS BIGINT) ya,
    CAST(floor(({_DBL.format(74.05)} - abs(end_lon)) / {_DBL.format(G.DELTA_LON)}) AS BIGINT) xb,
    CAST(floor(({_DBL.format(G.LAT_NORTH)} - end_lat) / {_DBL.format(G.DELTA_LAT)}) AS BIGINT) yb
  FROM ({_CLEAN_SQL})
  WHERE {_in_box_sql('start_lon', 'start_lat')} AND {_in_box_sql('end_lon', 'end_lat')}),
e AS (SELECT event_id, least(xa, xb) AS x0, CASE WHEN xa <= xb THEN ya ELSE yb END AS y0,
             abs(xb - xa) AS dx, CASE WHEN xa <= xb THEN yb - ya ELSE ya - yb END AS dy FROM g),
i AS (SELECT *, unnest(generate_series(0, dx)) AS i FROM e),
h AS (SELECT *, dy * greatest(2 * i - 1, 0) AS l, dy * least(2 * i + 1, 2 * dx) AS r FROM i),
s AS (SELECT x0, y0, i,
        CASE WHEN dx = 0 THEN least(dy, 0)
             ELSE CAST(floor((least(l, r) + dx) / (2.0 * dx)) AS BIGINT) END AS j0,
        CASE WHEN dx = 0 THEN greatest(dy, 0)
             ELSE CAST(ceil((greatest(l, r) - dx) / (2.0 * dx)) AS BIGINT) END AS j1 FROM h),
c AS (SELECT x0 + i AS x, y0 + unnest(generate_series(j0, greatest(j0, j1))) AS y FROM s)
SELECT CAST(x + y * 250 AS INTEGER) AS cell_id, count(*) AS cnt FROM c GROUP BY 1"""


@query("route_cell_counts", _ROUTE_CELLS_SQL)
def route_cell_counts(spark, d):
    """Route density: every grid cell each cleansed ride crosses, counted per cell."""
    cells = G.route_cells(ride_cleansing(spark, d), "start_lon", "start_lat", "end_lon",
                          "end_lat")
    return cells.groupBy("cell_id").agg(F.count(F.lit(1)).alias("cnt"))
