"""Plan shape guards: pushdown, pruning, no per-key windows, bounded broadcasts."""

import contextlib
import io
import re

import pytest

from eventide.plans import REGISTRY
from tests.conftest import SF001


def plan(spark, name):
    df = REGISTRY[name].fn(spark, SF001)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filter_and_columns_reach_the_scan(spark):
    p = plan(spark, "project_filter")
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in p
    assert "Exchange" not in p


@pytest.mark.parametrize("name", ["running_count", "running_argmax", "temporal_join",
                                  "session_window"])
def test_keyed_scans_never_window_by_key_alone(spark, name):
    p = plan(spark, name)
    assert "__piece" in p
    # a window partitioned by the key alone may only run over the per-(key, piece) summary
    # (ordered by piece: one row per piece), never over the rows ordered by time
    for m in re.finditer(r"windowspecdefinition\(__key#\d+, ([^ ]+) ", p):
        assert m.group(1).startswith("__piece"), m.group(0)


@contextlib.contextmanager
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def test_prefix_scan_shuffles_its_rows_once(spark):
    with no_broadcast(spark):
        tree = plan(spark, "running_count").split("\n\n\n")[0]
    # rows to (key, piece); the summary to (key, piece), to key, and back to (key, piece)
    assert tree.count("Exchange (") <= 4 and tree.count("Scan parquet") == 2
    # nothing lies between the rows' window and the join: no exchange over the window's output
    lines = [ln.strip(" +-:*").split(" (")[0].strip() for ln in tree.splitlines()]
    join = lines.index("SortMergeJoin Inner") if "SortMergeJoin Inner" in lines else next(
        i for i, ln in enumerate(lines) if ln.startswith("SortMergeJoin"))
    below = lines[join + 1:]
    assert "Exchange" not in below[:below.index("Window")]


@pytest.mark.parametrize("name", ["dedup_last", "dedup_first", "window_dedup", "rides_fares_join",
                                  "hourly_tips"])
def test_picks_are_hash_aggregates(spark, name):
    p = plan(spark, name)
    assert "SortAggregate" not in p and "HashAggregate" in p


def test_count_window_has_no_unpartitioned_row_window(spark):
    p = plan(spark, "count_window")
    # the only unpartitioned window is over the per-piece counts (one row per piece)
    assert "row_number()" in p and "__piece" in p


def test_interval_join_keys_include_the_time_bucket(spark):
    p = plan(spark, "interval_join")
    assert re.search(r"Left keys \[2\]: \[user_id#\d+L, __bucket#\d+L\]", p)


def test_grouped_picks_aggregate_before_the_shuffle(spark):
    for name in ("dedup_last", "hourly_tips", "long_ride_alerts"):
        p = plan(spark, name)
        tree = p.split("\n\n\n")[0]
        # a partial aggregate sits below every exchange of the grouped pick
        assert re.search(r"Exchange \(\d+\)\n\s*[+|-]*\s*(Sort|Hash)Aggregate", tree) or \
            re.search(r"Exchange[^\n]*\n[^\n]*Aggregate", tree), name


def test_top_n_limits_before_the_shuffle(spark):
    tree = plan(spark, "top_n").split("\n\n\n")[0]
    lines = [ln.strip(" +-:") for ln in tree.splitlines()]
    ex = next(i for i, ln in enumerate(lines) if ln.startswith("Exchange"))
    assert any(ln.startswith("WindowGroupLimit") for ln in lines[ex + 1:])


def test_no_cartesian_products(spark):
    for name, q in REGISTRY.items():
        if q.fn.__module__.rsplit(".", 1)[-1] in ("streams", "cdc") or "_source" in name:
            continue  # they run their stream to read its sink
        p = plan(spark, name)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
