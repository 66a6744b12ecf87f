"""Geo predicates and grid, record codecs."""

import json
import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions import codec as C
from eventide.functions import geo as G
from eventide.plans import records as R

CLEANSING = [  # (start lon, start lat, end lon, end lat, kept)
    (-73.85, 40.62, -73.91, 40.88, True),
    (-73.85, 40.62, -73.40, 40.88, False),              # leaves to the east
    (-73.85, 40.62, -73.91, 40.20, False),              # leaves to the south
    (-74.60, 40.62, -73.91, 40.88, False),              # comes from the west
    (-73.85, 41.75, 10.0, -20.0, False),
    # the corner longitudes are not exact as FLOAT: -74.05f < -74.05 and -73.7f > -73.7,
    # so as in the reference the float corners fall outside
    (-74.05, 40.5, -73.7, 41.0, False),
    (float("nan"), 40.7, -73.9, 40.7, True),            # NaN passes the negated test
]


def test_ride_cleansing_cases(spark):
    df = spark.createDataFrame([c[:4] for c in CLEANSING],
                               "slon float, slat float, elon float, elat float")
    got = [r.keep for r in df.select(
        (G.is_in_nyc("slon", "slat") & G.is_in_nyc("elon", "elat")).alias("keep")).collect()]
    assert got == [c[4] for c in CLEANSING]


def test_double_corners_are_inside(spark):
    df = spark.createDataFrame([(-74.05, 40.5, -73.7, 41.0)], "a double, b double, c double, d double")
    assert df.select((G.is_in_nyc("a", "b") & G.is_in_nyc("c", "d")).alias("k")).first().k


def test_grid_cell_and_centre(spark):
    df = spark.createDataFrame([(-73.8712, 40.613407)], "lon float, lat float")
    r = df.select(G.grid_cell("lon", "lat").alias("c")).first()
    x = math.floor((74.05 - abs(float(__import__("numpy").float32(-73.8712)))) / 0.0014)
    y = math.floor((41.0 - float(__import__("numpy").float32(40.613407))) / 0.00125)
    assert r.c == x + y * 250
    cen = spark.createDataFrame([(r.c,)], "c int").select(
        G.cell_center_lon("c").alias("lon"), G.cell_center_lat("c").alias("lat")).first()
    assert abs(cen.lon - (-73.8712)) < 0.0014 and abs(cen.lat - 40.613407) < 0.00125


def crossed(x1, y1, x2, y2):
    """Cells whose inside the segment between two cell centres meets, from exact fractions."""
    from fractions import Fraction as Q
    out = set()
    for x in range(min(x1, x2), max(x1, x2) + 1):
        for y in range(min(y1, y2), max(y1, y2) + 1):
            lo, hi = Q(0), Q(1)  # the part of the segment inside the open cell
            for a, b, c in ((x1, x2, x), (y1, y2, y)):
                if a == b:
                    if not abs(a - c) < Q(1, 2):
                        hi = lo
                    continue
                t = sorted([(c - Q(1, 2) - a) / (b - a), (c + Q(1, 2) - a) / (b - a)])
                lo, hi = max(lo, t[0]), min(hi, t[1])
            if lo < hi or (x1, y1) == (x2, y2):
                out.add(x + y * 250)
    return sorted(out)


def test_route_cells_are_the_crossed_ones(spark):
    import random
    r = random.Random(5)
    ends = [(10, 10, 10, 10), (10, 10, 15, 15), (15, 15, 10, 10), (10, 20, 10, 5), (5, 9, 20, 9),
            (10, 10, 13, 11), (10, 10, 11, 13)]
    ends += [tuple(r.randrange(60) for _ in range(4)) for _ in range(60)]

    def centre(x, y):
        return 74.05 * -1 + (x + 0.5) * 0.0014, 41.0 - (y + 0.5) * 0.00125
    rows = [(i, *centre(a, b), *centre(c, d)) for i, (a, b, c, d) in enumerate(ends)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double")
    got = {}
    for x in G.route_cells(df, "a", "b", "c", "d").collect():
        got.setdefault(x.id, []).append(x.cell_id)
    assert {i: sorted(v) for i, v in got.items()} == {
        i: crossed(*e) for i, e in enumerate(ends)}


def test_routes_with_nan_end(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, nan, 40.9, -73.9, 40.9), (2, nan, nan, nan, nan)],
                               "id int, a float, b float, c float, d float")
    got = [x.cell_id for x in G.route_cells(df, "a", "b", "c", "d").where("id = 2").collect()]
    assert got == [0]
    assert G.route_cells(df, "a", "b", "c", "d").where("id = 1").count() > 1


def test_distance_of_float_columns_widens_the_differences(spark):
    import numpy as np
    df = spark.createDataFrame([(-73.871234, 40.613407, -73.9123, 40.7771)],
                               "a float, b float, c float, d float")
    got = df.select(G.euclidean_distance("a", "b", "c", "d").alias("x")).first().x
    a, b, c, d = (np.float32(v) for v in (-73.871234, 40.613407, -73.9123, 40.7771))
    x, y = float(b - d), float(a - c) * math.cos(float(d))
    assert got == 110.25 * math.sqrt(x * x + y * y)


def test_direction_of_equal_points_is_defined(spark):
    df = spark.createDataFrame([(-73.9, 40.7), (-73.9, 47.2)], "a double, b double")
    assert [r.x for r in df.select(G.direction_angle("a", "b", "a", "b").alias("x")).collect()] \
        == [179, 179]


def test_header_text_rule(spark):
    schema = T.StructType([T.StructField("h", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])))])
    rows = [([],), ([("x", bytes([0x31]))],), ([("x", bytes([0, 1]))],),
            ([("x", b"a"), ("x", b"b")],), ([("x", bytes([0xC3, 0xA9]))],), ([("x", None)],)]
    df = spark.createDataFrame(rows, schema)
    got = [r.t for r in df.select(C.header_text("h", "x").alias("t")).collect()]
    assert got == ["<missing>", "1", "0x0001", "b", "0xc3a9", "<missing>"]


def test_click_timestamp_pattern_is_12_hour(spark):
    df = spark.createDataFrame([("2024-01-01 13:05:07.250",)], "s string").select(
        F.to_timestamp_ntz("s").alias("ts"))
    r = df.select(C.click_ts_text("ts").alias("t")).first()
    assert r.t == "01-01-2024 01:05:07:250"


def test_jdbc_sink_rows_cast_quoted_age(spark):
    recs = [{"Name": "Nora", "Role": "Pilot", "Age": "31"},
            {"Name": "Ivo", "Role": "Baker", "Age": "58"}, {"Name": "Lu", "Role": None, "Age": ""}]
    df = spark.createDataFrame([(json.dumps(r),) for r in recs[:2]], "value string")
    out = R.demo_rows(df)
    assert dict(out.dtypes)["Age"] == "int"
    assert sorted((r.Name, r.Age) for r in out.collect()) == [("Ivo", 58), ("Nora", 31)]


def test_sensor_record_round_trip(spark):
    rec = {"run_id": "r1", "event_id": "evt-0001", "host": "server-a", "metric": "cpu_load",
           "value": 42.5, "event_ts": 1700000000000}
    df = spark.createDataFrame([("sensor-1", json.dumps(rec))], "key string, value string")
    out = df.select("key", C.decode_json("value", R.SENSOR_SCHEMA).alias("r")).select("key", "r.*")
    assert out.first().asDict() == {"key": "sensor-1", **rec}


def test_schema_evolution_default(spark):
    v1 = json.dumps({"timestamp": 1, "hostname": "h", "counters": []})
    v2 = json.dumps({"timestamp": 2, "hostname": "h", "counters": [], "os_type": "linux"})
    df = spark.createDataFrame([(v1,), (v2,)], "value string")
    r = df.select(C.decode_json("value", R.MACHINE_V2).alias("r")).select(
        "r.timestamp", F.coalesce("r.os_type", F.lit(R.OS_TYPE_DEFAULT)).alias("os"))
    assert sorted((x.timestamp, x.os) for x in r.collect()) == [(1, "UNKNOWN"), (2, "linux")]


def test_replay_line_layout(spark):
    lines = spark.createDataFrame([("1,2,3,pv,1511658000",), ("4,5,6,buy,1511658001",),
                                   ("short,line",)], "line string")
    out = sorted((r.cycle, r.json) for r in R.replay(lines, 2).collect())
    assert len(out) == 4
    first = json.loads(out[0][1])
    assert out[0][1].startswith('{"user_id": "1", "item_id":"2", "category_id": "3"')
    assert first["ts"] == "2017-11-26 09:00:00"     # +8 h, no fraction
    # second cycle shifted by span (1 s) + 1 s
    assert json.loads(out[2][1])["ts"] == "2017-11-26 09:00:02"


def test_distance_to_point_uses_the_event_end(spark):
    df = spark.createDataFrame([(True, -73.99, 40.75, -73.90, 40.70),
                                (False, -73.99, 40.75, -73.90, 40.70)],
                               "s boolean, a double, b double, c double, d double")
    r = df.select(G.distance_to_point("s", "a", "b", "c", "d", F.lit(-73.99), F.lit(40.75))
                  .alias("x")).collect()
    assert r[0].x == 0.0 and r[1].x > 0.0


def test_instant_text_fraction_groups(spark):
    df = spark.createDataFrame([("2020-01-01 12:00:00",), ("2020-01-01 12:00:00.25",),
                                ("2020-01-01 12:00:00.000123",), ("1969-12-31 23:59:59.5",)],
                               "s string").select(F.to_timestamp_ntz("s").alias("t"))
    got = [r.x for r in df.select(C.instant_text("t").alias("x")).collect()]
    assert got == ["2020-01-01T12:00:00Z", "2020-01-01T12:00:00.250Z",
                   "2020-01-01T12:00:00.000123Z", "1969-12-31T23:59:59.500Z"]


def test_replay_of_no_cycles_is_empty(spark):
    lines = spark.createDataFrame([("1,2,3,pv,1511658000",)], "line string")
    assert R.replay(lines, 0).count() == 0 and R.replay(lines, -1).count() == 0


def test_lines_of_a_log_by_number(spark, tmp_path):
    from eventide.sources.tables import read_lines
    for n, (lo, hi) in enumerate([(0, 40), (40, 41), (41, 90)]):
        (tmp_path / f"part-{n}.csv").write_text("".join(f"line {i}\n" for i in range(lo, hi)))

    def got(*bounds):
        return sorted(int(r.line.split()[1]) for r in read_lines(spark, str(tmp_path), *bounds).collect())
    assert got() == list(range(90))
    assert got(38, 45) == list(range(38, 46))
    assert got(85) == list(range(85, 90)) and got(0, 0) == [0] and got(200) == []


def test_run_ids_are_unique():
    ids = {R.new_run_id() for _ in range(100)}
    assert len(ids) == 100


def test_tune_for_input_sizes_shuffles(spark):
    from eventide.session import tune_for_input
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        tune_for_input(spark, 100 * 2**40)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 100 * 2**40 // (256 << 20)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
