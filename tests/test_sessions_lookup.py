"""Sessions that merge on a stream, and lookups against a dimension that changes."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.streaming.lookup import Dimension, LookupJoin
from eventide.streaming.sessions import Sessions
from eventide.streaming.sinks import UpsertTable
from tests.test_ordered import ROWS, Stop, at, batches_of, frame, sample

GAP = 7


def sessions_in(spark, path, delay="30 minutes"):
    aggs = {"n": ("sum", F.lit(1).cast("long")), "low": ("min", F.col("v")),
            "total": ("sum", F.col("v"))}
    return Sessions(spark, str(path), ROWS, ["k"], "ts", f"{GAP} minutes", delay, aggs)


def brute(rows):
    out = {}
    for _, k, m, v in sorted((r for r in rows if r[2] is not None), key=lambda r: r[2]):
        last = out.setdefault(k, [])
        if last and m < last[-1][1] + GAP:
            s = last[-1]
            last[-1] = [s[0], m, s[2] + 1, min(s[3], v), s[4] + v]
        else:
            last.append([m, m, 1, v, v])
    return sorted((str(k), at(s), at(e + GAP), n, low, total)
                  for k, found in out.items() for s, e, n, low, total in found)


def got(sessions):
    return sorted((str(r.k), r.window_start, r.window_end, r.n, r.low, r.total)
                  for r in sessions.read().collect())


@pytest.mark.parametrize("seed, batches", [(1, 1), (2, 6)])
def test_sessions_in_any_order_of_arrival(spark, tmp_path, seed, batches):
    rows = sample(240, seed)
    rows += [(1000 + i, *r[1:]) for i, r in enumerate(rows[::9])]  # repeated rows
    rows.append((5000, 1, None, 1.0))
    s = sessions_in(spark, tmp_path)
    for b, batch in enumerate(batches_of(rows, 2, batches, 30, seed)):
        s.write(frame(spark, batch), b)
    if batches > 1:
        # closed sessions leave the state, and come out before the end
        assert 0 < s.closed.read().count() and s.merged.at(s.merged.last()).count() < 60
    s.finish()
    assert got(s) == brute(rows)


def test_a_hot_key_ships_intervals(spark, tmp_path):
    rows = [(i, 0, i % 90, 1.0) for i in range(3000)] + [(9000, 2, 500, 1.0)]
    s = sessions_in(spark, tmp_path)
    s.write(frame(spark, rows), 0)
    # 90 minutes touch at most 14 stretches of 7, and the other key has one
    assert s.turn.at(0).count() <= 89 // GAP + 2 + 1
    s.finish()
    assert got(s) == brute(rows)


def test_a_late_row_merges_two_open_sessions_or_fails_the_run(spark, tmp_path):
    rows = [(1, 1, 0, 1.0), (2, 1, 10, 1.0), (3, 1, 5, 1.0)]
    s = sessions_in(spark, tmp_path / "a")
    s.write(frame(spark, rows[:2]), 0)
    assert s.merged.at(0).count() == 2
    s.write(frame(spark, rows[2:]), 1)
    assert s.merged.at(1).count() == 1
    s.finish()
    assert got(s) == brute(rows)
    s = sessions_in(spark, tmp_path / "b", delay="0 seconds")
    s.write(frame(spark, [(1, 1, 50, 1.0)]), 0)
    s.write(frame(spark, [(2, 1, 49, 1.0), (3, 1, 50, 2.0)]), 1)
    with pytest.raises(RuntimeError, match="later than the watermark"):
        s.finish()
    assert [r.id for r in s.late.read().collect()] == [2]
    assert got(s) == brute([(1, 1, 50, 1.0), (3, 1, 50, 2.0)])


def test_no_rows(spark, tmp_path):
    s = sessions_in(spark, tmp_path)
    s.finish()
    assert got(s) == []
    s.write(frame(spark, []), 0)
    s.write(frame(spark, [(1, None, None, 1.0)]), 1)
    s.finish()
    assert got(s) == []


def test_a_batch_that_died_after_any_step_is_run_again(spark, tmp_path, monkeypatch):
    rows = sample(60, 3)
    first, second = batches_of(rows, 2, 2, 30, 3)
    s = sessions_in(spark, tmp_path)
    s.write(frame(spark, first), 0)
    batch, step = frame(spark, second).coalesce(1), 0
    while True:
        step, left = step + 1, [step + 1]

        def done(self, name):
            left[0] -= 1
            if not left[0]:
                raise Stop

        monkeypatch.setattr(UpsertTable, "_done", done)
        try:
            s.write(batch, 1)
            break
        except Stop:
            continue
        finally:
            monkeypatch.undo()
    assert step > 9
    s.finish()
    assert got(s) == brute(rows)


DIM = T.StructType([T.StructField("k", T.LongType()), T.StructField("name", T.StringType())])
FACT = T.StructType([T.StructField("id", T.LongType()), T.StructField("k", T.LongType())])


def found(join):
    return sorted(((r.id, r.k, r.name) for r in join.read().collect()), key=str)


def test_each_batch_gets_the_version_in_force(spark, tmp_path):
    dim = Dimension(spark, f"{tmp_path}/d", DIM, newest=2)
    join = LookupJoin(spark, f"{tmp_path}/j", FACT, dim, ["k"])
    facts = spark.createDataFrame([(1, 1), (2, 2), (3, None)], FACT)
    with pytest.raises(RuntimeError, match="no version"):
        join.write(facts, 0)
    assert dim.publish(spark.createDataFrame([(1, "a"), (None, "x")], DIM)) == 0
    join.write(facts, 0)
    assert dim.publish(spark.createDataFrame([(None, "x"), (1, "a")], DIM)) == 0  # nothing new
    assert dim.publish(spark.createDataFrame([(1, "b"), (2, "c"), (2, "d")], DIM)) == 1
    join.write(facts, 0)  # already done: stays as it was
    assert found(join) == [(1, 1, "a"), (2, 2, None), (3, None, None)]
    join.write(facts, 1)
    assert dim.publish(spark.createDataFrame([], DIM)) == 2
    join.write(facts, 2)
    assert join.versions() == {0: 0, 1: 1, 2: 2}
    assert found(join) == sorted([(1, 1, "a"), (2, 2, None), (3, None, None),
                                  (1, 1, "b"), (2, 2, "c"), (2, 2, "d"), (3, None, None),
                                  (1, 1, None), (2, 2, None), (3, None, None)], key=str)
    assert len(dim.manifest.names(f"{tmp_path}/d/data")) <= 3


def test_broadcast_only_up_to_the_measured_size(spark, tmp_path):
    rows = spark.createDataFrame([(k, "n" * 50) for k in range(100)], DIM)
    facts = spark.createDataFrame([(i, i % 200) for i in range(400)], FACT)
    plans = []
    for limit in (1 << 20, 1000):
        dim = Dimension(spark, f"{tmp_path}/d{limit}", DIM)
        dim.publish(rows)
        assert 5000 < dim.note(0)["bytes"] < 10000
        join = LookupJoin(spark, f"{tmp_path}/j{limit}", FACT, dim, ["k"], broadcast_bytes=limit)
        kept = join.joined.write
        join.joined.write = lambda df, *a: (plans.append(
            df._jdf.queryExecution().logical().toString()), kept(df, *a))
        join.write(facts, 0)
        assert join.read().where("name is not null").count() == 200
    assert "broadcast" in plans[0] and "broadcast" not in plans[1]


def test_clashing_names_are_refused(spark, tmp_path):
    dim = Dimension(spark, f"{tmp_path}/d", T.StructType([*DIM.fields, T.StructField("id", T.LongType())]))
    with pytest.raises(ValueError, match="rename"):
        LookupJoin(spark, f"{tmp_path}/j", FACT, dim, ["k"])


def test_a_refresh_for_every_batch(spark, tmp_path):
    dim = Dimension(spark, f"{tmp_path}/d", DIM)
    join = LookupJoin(spark, f"{tmp_path}/j", FACT, dim, ["k"],
                      refresh=lambda b: spark.createDataFrame([(1, f"v{b // 2}")], DIM))
    for b in range(4):
        join.write(spark.createDataFrame([(b, 1)], FACT), b)
    assert join.versions() == {0: 0, 1: 0, 2: 1, 3: 1}
    assert found(join) == [(0, 1, "v0"), (1, 1, "v0"), (2, 1, "v1"), (3, 1, "v1")]
