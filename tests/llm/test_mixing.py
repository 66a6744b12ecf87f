"""Mixing: targets by repeated resharing, words taken, positions."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eventide.llm import mixing as M
from tests.llm.data import CLASH, docs, odd_rows, prose


def targets(sizes, cap=3, weights=(1, 2, 3)):
    """Share by weight; what exceeds a cap is shared again among the rest, until nothing does."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, out, free = sum(sizes.values()), {}, set(names)
    while free:
        level = (total - sum(out.values())) / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > cap * sizes[s]}
        if not over:
            return out | {s: level * w[s] for s in free}
        out |= {s: cap * sizes[s] for s in over}
        free -= over
    return out


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def check(rows, got):
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += words(t)
    want = targets(sizes)
    by = defaultdict(int)
    for r in got:
        assert r.target == pytest.approx(want[r.source], rel=1e-9)
        assert r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r["size"]
        assert (r.position is None) == (r.taken == 0)
        assert r.position is None or 0 <= r.position <= 1
        by[r.source] += r.taken
    for s in sizes:
        assert by[s] == int(want[s] + 1e-9), s


def rows_of(counts, seed=0):
    return [(i * 100 + k, prose(seed + i * 100 + k, 5 + (k * 37) % 90), "en", s)
            for i, (s, n) in enumerate(counts.items()) for k in range(n)]


@pytest.mark.parametrize("counts", [
    {"a": 40, "b": 5, "c": 1, None: 3}, {"only": 9}, {"a": 3, "b": 3, "c": 3},
    {"Z": 60, "a": 1, "é": 1, "zz": 2, "漢": 8, None: 1, "b": 1}])
def test_targets_and_words(spark, counts):
    rows = rows_of(counts)
    got = M.mix(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    check(rows, got)


def test_odd_rows(spark):
    rows = odd_rows()
    got = M.mix(docs(spark, rows, CLASH)).collect()
    assert len(got) == len(rows)
    check(rows, got)
    assert all(r.taken == 0 for r in got if r["size"] == 0)


def test_reruns_agree_and_do_not_depend_on_partitions(spark):
    rows = rows_of({"a": 30, "b": 7, "c": 2})
    one = sorted(map(tuple, M.mix(docs(spark, rows)).collect()), key=str)
    two = sorted(map(tuple, M.mix(docs(spark, rows[::-1]).repartition(7)).collect()), key=str)
    assert one == two


def test_demand_time_inverts_the_integral(spark):
    for knots in (M.FLAT, M.EARLY, M.LATE, ((0.0, 0.0), (1.0, 1.0)), ((0.0, 0.0), (0.5, 0.0), (1.0, 2.0))):
        df = spark.range(0, 101).select((F.col("id") / 100).alias("s"))
        got = df.select("s", M.demand_time(F.col("s"), knots).alias("t")).collect()

        def integral(t):
            a = 0.0
            for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
                x = min(max(t - t0, 0), t1 - t0)
                a += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
            return a

        assert all(integral(r.t) / integral(1.0) == pytest.approx(r.s, abs=1e-9) for r in got)
    with pytest.raises(ValueError):
        M.demand_time(F.lit(0.5), ((0.0, 1.0), (0.0, 1.0)))


def test_schedules_move_sources_in_time(spark):
    df = docs(spark, rows_of({"a": 200, "b": 200, "c": 200}))

    def at(**options):
        return {r.doc_id: (r.source, r.position) for r in M.mix(df, **options).where("taken > 0").collect()}
    flat, used = at(schedules=lambda w: [(F.lit(True), M.FLAT)]), at()
    assert flat.keys() == used.keys()
    for i, (source, t) in used.items():  # weights 1, 2, 3: early, flat, late
        before = flat[i][1]
        assert {"a": t <= before, "b": t == pytest.approx(before), "c": t >= before}[source]
    assert sum(used[i][1] < flat[i][1] - 0.05 for i in used) > 20


def test_mixed_documents(spark):
    rows = rows_of({"a": 30, "b": 6, "c": 1}) + [(9999, None, None, "c"), (9999, "", None, None)]
    df = docs(spark, rows, CLASH)
    mixed = M.mix(df).where("taken > 0")
    want = {r.doc_id: -(-r.taken // r["size"]) for r in mixed.collect()}
    out = M.mixed_documents(df)
    assert out.schema == df.schema
    got = out.collect()
    assert {i: sum(r.doc_id == i for r in got) for i in {r.doc_id for r in got}} == want
    texts = {i: t for i, t, *_ in rows}
    assert all(r.text == texts[r.doc_id] for r in got)


def test_training_order_is_sorted(spark):
    rows = rows_of({"a": 30, "b": 6})
    at = [r.position for r in M.training_order(M.mix(docs(spark, rows))).collect()]
    taken = [x for x in at if x is not None]
    assert taken == sorted(taken) and at[:len(taken)] == taken


def test_empty_table(spark):
    assert M.mix(docs(spark, [])).collect() == []
    assert M.mixed_documents(docs(spark, [])).collect() == []
