"""Streams with tables as state: rows in event order, temporal join, running results, ranking."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.streaming.ordered import BatchLog, RankedChanges, RunningResults, TemporalJoin
from eventide.streaming.sinks import UpsertTable

T0 = dt.datetime(2024, 1, 1)
ROWS = T.StructType([T.StructField("id", T.LongType()), T.StructField("k", T.LongType()),
                     T.StructField("ts", T.TimestampType()), T.StructField("v", T.DoubleType())])


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def sample(n, seed):
    """Rows (id, k, minute, v): key 0 holds a third, some keys are null, minutes repeat."""
    r = random.Random(seed)
    return [(i, 0 if i % 3 == 0 else r.choice([None, 1, 2, 3, 4]), r.randrange(600),
             float(r.randrange(20))) for i in range(n)]


def batches_of(rows, minute, n, disorder, seed):
    """Rows in ``n`` batches by arrival, at most ``disorder`` minutes after their time."""
    r = random.Random(seed)
    arriving = sorted(rows, key=lambda x: (x[minute] or 0) + r.uniform(0, disorder))
    size = -(-len(arriving) // n)
    return [arriving[i:i + size] for i in range(0, len(arriving), size)]


def frame(spark, rows):
    return spark.createDataFrame([(i, k, at(m), v) for i, k, m, v in rows], ROWS)


class Stop(Exception):
    pass


def interrupted(monkeypatch, write):
    """Run ``write`` again and again, each time stopped one step later, until it comes through."""
    step = 0
    while True:
        step, left = step + 1, [step + 1]

        def done(self, name):
            left[0] -= 1
            if not left[0]:
                raise Stop

        monkeypatch.setattr(UpsertTable, "_done", done)
        try:
            write()
            return step
        except Stop:
            continue
        finally:
            monkeypatch.undo()


def test_batch_log_replaces_a_batch_and_keeps_the_newest(spark, tmp_path):
    schema = T.StructType([T.StructField("x", T.LongType())])
    every, two = BatchLog(spark, f"{tmp_path}/a", schema), BatchLog(spark, f"{tmp_path}/b", schema, 2)
    assert every.read().count() == 0 and every.last() is None and every.note(None) is None
    for b in (0, 1, 1, 2, 3):
        for log in (every, two):
            log.write(spark.range(b + 1).toDF("x"), b, note=b * 10)
    assert every.read().count() == 1 + 2 + 3 + 4
    assert two.read().count() == 3 + 4 and two.last() == 3 and two.last(3) == 2
    assert two.note(3) == 30 and two.note(1) is None and two.at(1).count() == 0
    held = {n for m in two.manifest.numbers() for n in two.manifest.read(m)["deltas"].values()}
    assert set(two.manifest.names(f"{tmp_path}/b/data")) == held  # nothing else is left


def running(spark, path, delay="60 minutes"):
    best = F.struct(F.col("v"), (-F.col("id")).alias("neg_id"))
    return RunningResults(spark, str(path), ROWS, "ts", delay, ["k"], "id", {
        "n": ("sum", F.lit(1).cast("long")), "best": ("max", best)})


def running_by_hand(rows):
    out, count, best = {}, {}, {}
    for i, k, m, v in sorted(rows, key=lambda r: (r[2], r[0])):
        count[k] = count.get(k, 0) + 1
        best[k] = max(best.get(k, (v, -i)), (v, -i))
        out[i] = (count[k], best[k][0], -best[k][1])
    return out


def results(run):
    rows = run.read().collect()
    assert len({r.id for r in rows}) == len(rows)
    return {r.id: (r.n, r.best.v, -r.best.neg_id) for r in rows}


def test_running_results_out_of_order_with_a_hot_key(spark, tmp_path):
    rows = sample(600, 1)
    run = running(spark, tmp_path)
    for b, part in enumerate(batches_of(rows, 2, 5, 60, 2)):
        run.write(frame(spark, part), b)
        assert run.carry.read().count() <= 6          # one row per key, null included
        waits = run.waiting.at(b).agg(F.min("ts"), F.max("ts")).first()
        assert waits[1] is None or waits[1] - waits[0] <= dt.timedelta(minutes=60)
    run.finish()
    assert results(run) == running_by_hand(rows)


def test_running_results_survive_a_stop_after_every_step(spark, tmp_path, monkeypatch):
    rows = sample(90, 3)
    run = running(spark, tmp_path)
    first, second, third = batches_of(rows, 2, 3, 60, 4)
    run.write(frame(spark, first), 0)
    steps = interrupted(monkeypatch, lambda: run.write(frame(spark, second), 1))
    assert steps >= 15  # five tables, three steps each
    run.write(frame(spark, third), 2)
    run.finish()
    assert results(run) == running_by_hand(rows)


def test_late_rows_are_kept_and_fail_a_lossless_run(spark, tmp_path):
    run = running(spark, tmp_path, "10 minutes")
    run.write(frame(spark, [(1, 1, 100, 1.0)]), 0)
    run.write(frame(spark, [(2, 1, 90, 1.0), (3, 1, 89, 5.0), (4, 1, None, 0.0)]), 1)
    with pytest.raises(RuntimeError, match="later than the watermark"):
        run.finish()
    assert [r.id for r in run.late.read().collect()] == [3]
    # row 4 has no time: the earliest of its batch
    assert {i: n for i, (n, _, _) in results(run).items()} == {4: 1, 2: 2, 1: 3}


def test_empty_streams(spark, tmp_path):
    run = running(spark, f"{tmp_path}/r")
    run.finish()
    run.write(frame(spark, []), 0)
    run.finish()
    assert run.read().count() == 0
    top = RankedChanges(spark, f"{tmp_path}/t", ROWS, ["k"], [F.col("v").desc()], 2)
    top.write(frame(spark, []), 0)
    assert top.read().count() == 0 and top.changes().count() == 0


def feed(spark, lefts, rights):
    left = frame(spark, lefts).selectExpr("id", "k", "ts", "v")
    right = frame(spark, rights).selectExpr("id AS vid", "k", "ts AS since", "v AS rate")
    return TemporalJoin.merge(left, right, "k", "ts", "since", "id", "vid")


def joined_by_hand(lefts, rights):
    out = {}
    for i, k, m, _ in lefts:
        fit = [(rm, ri) for ri, rk, rm, _ in rights
               if None not in (k, m, rm) and rk == k and rm <= m]
        out[i] = max(fit)[1] if fit else None
    return out


def test_temporal_join_out_of_order(spark, tmp_path, monkeypatch):
    lefts, rights = sample(300, 5), sample(120, 6)
    both = [(*r, 0) for r in lefts] + [(*r, 1) for r in rights]
    join = None
    for b, part in enumerate(batches_of(both, 2, 5, 90, 7)):
        rows = feed(spark, [r[:4] for r in part if not r[4]], [r[:4] for r in part if r[4]])
        join = join or TemporalJoin(spark, str(tmp_path), rows.schema, "90 minutes")
        if b == 2:
            assert interrupted(monkeypatch, lambda: join.write(rows, b)) >= 15
        else:
            join.write(rows, b)
        assert join.versions.read().count() <= 5      # older versions are gone
    join.finish()
    got = join.read().collect()
    assert len(got) == len(lefts)
    assert {r.id: r.vid for r in got} == joined_by_hand(lefts, rights)


def test_temporal_join_nulls_and_equal_times(spark, tmp_path):
    lefts = [(1, None, 5, 0.0), (2, 1, None, 0.0), (3, 1, 5, 0.0), (4, 1, 4, 0.0), (5, 9, 5, 0.0)]
    rights = [(10, 1, 5, 1.0), (11, 1, 5, 2.0), (12, None, 1, 3.0), (13, 1, None, 4.0)]
    rows = feed(spark, lefts, rights)
    join = TemporalJoin(spark, str(tmp_path), rows.schema, "1 minute")
    join.write(rows, 0)
    join.finish()
    got = {r.id: (r.vid, r.rate) for r in join.read().collect()}
    none = (None, None)
    assert got == {1: none, 2: none, 3: (11, 2.0), 4: none, 5: none}
    with pytest.raises(ValueError, match="rename"):
        TemporalJoin.merge(frame(spark, []), frame(spark, []), "k", "ts", "ts", "id", "id")


def test_ranked_changes_hold_n_rows_per_key(spark, tmp_path, monkeypatch):
    rows = sample(400, 8)
    top = RankedChanges(spark, str(tmp_path), ROWS, ["k"],
                        [F.col("v").desc(), F.col("id")], 3)
    seen, folded = [], {}
    for b in range(4):
        part = rows[b * 100:(b + 1) * 100]
        seen += part
        if b == 1:
            assert interrupted(monkeypatch, lambda: top.write(frame(spark, part), b)) >= 6
        else:
            top.write(frame(spark, part), b)
        want = {}
        for i, k, _, v in sorted(seen, key=lambda r: (-r[3], r[0])):
            n = sum(1 for kk, _ in want if kk == k) + 1
            if n <= 3:
                want[(k, n)] = i
        got = top.read().collect()
        assert {(r.k, r.rn): r.id for r in got} == want and len(got) == len(want)
        changes = top.log.at(b).collect()
        for r in changes:                              # retractions name what is there
            if r.op == "-U":
                assert folded.pop((r.k, r.rn)) == r.id
        for r in changes:
            if r.op != "-U":
                assert (r.k, r.rn) not in folded
                folded[(r.k, r.rn)] = r.id
        assert folded == want


def test_equal_rows_take_places_of_their_own(spark, tmp_path):
    top = RankedChanges(spark, str(tmp_path), ROWS, ["k"], [F.col("v").desc()], 2)
    twice = [(1, 1, 0, 5.0)] * 2
    top.write(frame(spark, twice), 0)
    top.write(frame(spark, twice), 1)
    assert [(r.id, r.rn) for r in top.read().orderBy("rn").collect()] == [(1, 1), (1, 2)]
    assert top.log.at(1).count() == 0                  # nothing changed
