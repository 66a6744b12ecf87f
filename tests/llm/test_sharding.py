"""Sharding: proportions, movement, slots, and a copy of the draws in plain Python."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from eventide.llm import sharding as S
from tests.llm.data import CLASH, docs, odd_rows


def placed(spark, layout, n=20_000):
    ids = spark.range(n).withColumnRenamed("id", "doc_id")
    return {r.doc_id: r.shard for r in S.assign_shards(ids, layout).collect()}


def draw(doc_id, name, weight):
    h = xxhash.xxh64_intdigest(name.encode(), 42)
    h = xxhash.xxh64_intdigest((doc_id & (2**64 - 1)).to_bytes(8, "little"), h)
    return -math.log(((h >> 11) + 0.5) / 2.0**53) / weight


def brute(doc_id, layout):
    path = ()
    for level in range(3):
        total = defaultdict(float)
        for s in layout:
            p = (s.region, s.rack, s.shard)
            if p[:level] == path:
                total[p[level]] += s.weight
        path += (min(total, key=lambda c: draw(doc_id, "/".join(map(str, (*path, c))), total[c])),)
    return path[-1]


def test_same_as_brute_force(spark):
    layout = S.grow([*S.tree(7), S.Shard(1, 1, 7, 2.5)])
    got = placed(spark, layout, 300)
    assert got == {i: brute(i, layout) for i in range(300)}


@pytest.mark.parametrize("n", [1, 3, 8])
def test_one_more_shard_takes_rows_only_into_itself(spark, n):
    before, after = placed(spark, S.tree(n)), placed(spark, S.grow(S.tree(n)))
    moved = {i for i in before if before[i] != after[i]}
    assert {after[i] for i in moved} == {n}
    assert len(moved) == pytest.approx(len(before) / (n + 1), rel=0.1)


def test_rows_follow_weights_and_movement_stays_inside(spark):
    layout = [S.Shard(s.region, s.rack, s.shard, 1.0 + s.shard) for s in S.tree(8)]
    got = Counter(placed(spark, layout).values())
    for s in layout:
        assert got[s.shard] == pytest.approx(20_000 * s.weight / 36, rel=0.12)
    # weights move between two racks of region 0: region 1 keeps every row
    moved = [S.Shard(0, 0, 0, 2.0), S.Shard(0, 0, 1, 3.0), *layout[2:]]
    a, b = placed(spark, layout), placed(spark, moved)
    assert all(a[i] == b[i] for i in a if a[i] >= 4 and b[i] >= 4)
    same = [S.Shard(s.region, s.rack, s.shard, {0: 2.0, 1: 1.0}.get(s.shard, s.weight))
            for s in layout]
    c = placed(spark, same)  # the rack's total is unchanged: nothing leaves or enters it
    assert all({a[i], c[i]} <= {0, 1} for i in a if a[i] != c[i])


def test_odd_rows(spark):
    rows = odd_rows()
    got = S.shard_rows(docs(spark, rows, CLASH), S.tree(8)).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
                   for i, t, *_ in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert r.law == "key" and r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_slots_of_many_equal_rows(spark):
    same = spark.range(500).select(F.lit(3).cast("long").alias("doc_id"), F.lit("x").alias("text"))
    got = S.shard_rows(same, S.tree(8)).collect()
    assert sorted(r.slot for r in got) == list(range(500))


def test_written_shards(spark, tmp_path):
    df = docs(spark, [(i, f"text {i}") for i in range(50)])
    S.write_shards(df, S.tree(8), str(tmp_path / "s"))
    again = spark.read.parquet(str(tmp_path / "s"))
    assert {(r.doc_id, r.shard) for r in again.collect()} == {
        (i, brute(i, S.tree(8))) for i in range(50)}


def test_empty_table(spark):
    assert S.shard_rows(docs(spark, []), S.tree(8)).collect() == []
    with pytest.raises(ValueError):
        S.place(F.col("x"), [])
