"""Randomised checks of the window and scan operators against plain-Python brute force."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventide.operators import windows as W
from eventide.operators.scan import prefix_scan

BASE = dt.datetime(2024, 1, 1)
MIN = dt.timedelta(minutes=1)

events = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 600)), min_size=1, max_size=60)
SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _df(spark, rows):
    return spark.createDataFrame([(i, k, BASE + m * MIN) for i, (k, m) in enumerate(rows)],
                                 "id long, k long, ts timestamp_ntz")


@SETTINGS
@given(rows=events)
def test_hop_and_cumulate_counts(spark, rows):
    df = _df(spark, rows)
    got = {(r.window_start, r.window_end, r.k): r.n for r in W.hop_agg(
        df, "ts", "20 minutes", "1 hour", {"n": ("count", F.lit(1))}, keys=["k"]).collect()}
    want = {}
    for k, m in rows:
        for s in range((m // 20) * 20 - 40, (m // 20) * 20 + 1, 20):
            key = (BASE + s * MIN, BASE + (s + 60) * MIN, k)
            want[key] = want.get(key, 0) + 1
    assert got == want
    got = {(r.window_start, r.window_end): r.n for r in W.cumulate_agg(
        df, "ts", "15 minutes", "1 hour", {"n": ("count", F.lit(1))}).collect()}
    want = {}
    for _, m in rows:
        start = (m // 60) * 60
        for e in range((m // 15) * 15 + 15, start + 61, 15):
            key = (BASE + start * MIN, BASE + e * MIN)
            want[key] = want.get(key, 0) + 1
    assert got == want


@SETTINGS
@given(rows=events)
def test_sessions_and_running_counts(spark, rows):
    df = _df(spark, rows)
    got = sorted((r.k, r.window_start, r.n) for r in W.session_agg(
        df, ["k"], "ts", "45 minutes", F.count(F.lit(1)).alias("n")).collect())
    want = []
    for k in sorted({k for k, _ in rows}):
        times = sorted(m for kk, m in rows if kk == k)
        start, n, last = times[0], 1, times[0]
        for m in times[1:]:
            if m >= last + 45:
                want.append((k, BASE + start * MIN, n))
                start, n = m, 0
            n, last = n + 1, m
        want.append((k, BASE + start * MIN, n))
    assert got == sorted(want)
    got = {r.id: r.c for r in prefix_scan(df, ["k"], ["ts", "id"],
                                          {"c": ("count", F.lit(1))}, pieces=4).collect()}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][1], i))
    seen, want = {}, {}
    for i in order:
        seen[rows[i][0]] = seen.get(rows[i][0], 0) + 1
        want[i] = seen[rows[i][0]]
    assert got == want


pairs = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 900)), min_size=0, max_size=40)


@SETTINGS
@given(left=pairs, right=pairs)
def test_interval_and_asof_joins(spark, left, right):
    from eventide.operators import joins as J
    lrows = [(i, k, BASE + m * MIN) for i, (k, m) in enumerate(left)]
    rrows = [(100 + i, k, BASE + m * MIN) for i, (k, m) in enumerate(right)]
    ldf = spark.createDataFrame(lrows, "lid long, k long, lts timestamp_ntz")
    rdf = spark.createDataFrame(rrows, "rid long, k long, rts timestamp_ntz")
    got = {(r.lid, r.rid) for r in J.interval_join(
        ldf, rdf, "k", "lts", "rts", "-90 minutes", "15 minutes").collect()}
    want = {(li, ri) for li, lk, lt in lrows for ri, rk, rt in rrows
            if lk == rk and lt - 90 * MIN <= rt <= lt + 15 * MIN}
    assert got == want
    got = {r.lid: r.rid for r in J.asof_join(ldf, rdf, "k", "lts", "rts", "lid", "rid",
                                             ["rid"]).collect()}
    want = {}
    for li, lk, lt in lrows:
        cands = [(rt, ri) for ri, rk, rt in rrows if rk == lk and rt <= lt]
        want[li] = max(cands)[1] if cands else None
    assert got == want


@SETTINGS
@given(n=st.integers(1, 7), size=st.integers(0, 300))
def test_count_windows_keep_only_full_windows(spark, n, size):
    df = spark.range(size).select((F.col("id") * 5 + 3).alias("v"))
    out = W.count_window_agg(df, ["v"], n, F.min("v").alias("lo"), F.count(F.lit(1)).alias("c"))
    got = sorted((r.window_id, r.lo) for r in out.collect())
    assert got == [(w, w * n * 5 + 3) for w in range(size // n)]
