"""Streaming jobs over the events: no row is lost, whatever files the table consists of."""

import os

import pytest
from pyspark.sql import functions as F

from eventide.functions import codec as C
from eventide.plans import REGISTRY
from eventide.sources.tables import read_table, read_table_stream
from eventide.streaming import clicks as K
from eventide.streaming import sinks
from eventide.streaming.replay import record_stream
from eventide.streaming.windows import window_agg_stream
from tests.conftest import SF001


@pytest.fixture(scope="module")
def layouts(spark, tmp_path_factory):
    """The tables as one file each, as folders of part files, and with the rows of those files
    in reverse event order."""
    out = {"file": SF001}
    for name, descending in (("folder", False), ("reversed", True)):
        top = str(tmp_path_factory.mktemp(name))
        for t, key in (("events", "event_id"), ("orders", "o_orderdate"),
                       ("lineitem", "l_shipdate"), ("customer", "c_custkey"),
                       ("nation", "n_nationkey")):
            order = F.col(key).desc() if descending else F.col(key)
            (read_table(spark, SF001, t).repartitionByRange(5, order)
             .sortWithinPartitions(order).write.parquet(os.path.join(top, f"{t}.parquet")))
        out[name] = top
    return out


@pytest.mark.parametrize("name", ["click_count_job", "continuous_insert", "changelog_upsert",
                                  "cdc_materialize", "json_click_source", "json_table_source",
                                  "hourly_tips_stream", "processing_time_totals",
                                  "long_ride_alerts_stream", "rides_fares_stream"])
def test_the_answer_does_not_depend_on_files(spark, layouts, name):
    def rows(d):
        return sorted(map(str, REGISTRY[name].fn(spark, d).collect()))
    want = rows(layouts["file"])
    assert want and rows(layouts["folder"]) == want and rows(layouts["reversed"]) == want


def test_every_click_is_counted(spark, layouts):
    for d in layouts.values():
        n = read_table(spark, d, "events").count()
        got = REGISTRY["click_count_job"].fn(spark, d)
        assert got.agg(F.sum("click_count")).first()[0] == n
        src = read_table_stream(spark, d, "events")
        out = window_agg_stream(src, "ts", "1 second", "1 minute", F.count(F.lit(1)).alias("n"))
        q = sinks.run_to_end(out, "probe", sink="noop", output_mode="update")
        assert sinks.rows_dropped(q) == 0
        assert sum(p.numInputRows for p in q.recentProgress) == n


def test_lost_rows_are_an_error(spark, tmp_path):
    def part(folder, ts):
        spark.sql(f"SELECT TIMESTAMP '{ts}' AS ts").coalesce(1).write.mode("append").parquet(folder)
    folder, ck = str(tmp_path / "in"), str(tmp_path / "ck")
    part(folder, "2024-01-01 12:00:00")
    out = window_agg_stream(spark.readStream.schema("ts timestamp").parquet(folder), "ts",
                            "1 minute", "1 hour", F.count(F.lit(1)).alias("n"))
    for ts in ("2024-01-02 00:00:00", "2024-01-03 00:00:00"):
        part(folder, ts)
        sinks.run_to_end(out, "late", sink="noop", checkpoint=ck)
    part(folder, "2024-01-01 00:00:00")
    with pytest.raises(RuntimeError, match="later than the watermark"):
        sinks.run_to_end(out, "late", sink="noop", checkpoint=ck)


def test_statistics_across_a_restart(spark, tmp_path):
    schema = "page string, timestamp string"
    folder = str(tmp_path / "in")

    def clicks(lo, hi):
        made = spark.range(lo, hi).select(
            F.concat(F.lit("/p"), (F.col("id") % 3).cast("string")).alias("page"),
            F.timestamp_millis(F.col("id") * 50).cast("timestamp_ntz").alias("ts"))
        made.select(C.encode_json(C.click_ts_text("ts").alias("timestamp"), F.col("page"))
                    .alias("value")).write.mode("append").text(folder)

    clicks(0, 1000)
    stats = K.click_statistics(spark.readStream.text(folder))
    table = sinks.UpsertTable(spark, str(tmp_path / "out"), stats.schema, ["page", "window_start"])
    for lo, hi in ((1000, 1500), (1500, 2100)):
        sinks.run_to_end(stats, "restart", output_mode="update", foreach_batch=table.write,
                         checkpoint=str(tmp_path / "ck"))
        clicks(lo, hi)
    sinks.run_to_end(stats, "restart", output_mode="update", foreach_batch=table.write,
                     checkpoint=str(tmp_path / "ck"))
    got = {(r.page, r.window_start.minute * 60 + r.window_start.second): r["count"]
           for r in table.read().collect()}
    want = {}
    for i in range(2100):
        k = (f"/p{i % 3}", i * 50 // 15000 * 15)
        want[k] = want.get(k, 0) + 1
    assert got == want and schema


def test_records_are_read_back_whole(spark):
    values = spark.range(50).select(F.to_json(F.struct("id")).alias("value")).repartition(6)
    q = sinks.run_to_end(record_stream(values, "probe"), "records", sink="noop")
    assert sum(p.numInputRows for p in q.recentProgress) == 50
