"""SimHash: fingerprints, plans, links and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from eventide.llm import simhash_dedup as H
from eventide.llm.components import connected_components
from tests.llm.data import CLASH, docs, odd_rows, prose


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64)
               if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, links):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute_components(fps, radius=2):
    return roots(len(fps), [(i, j) for i in range(len(fps)) for j in range(i)
                            if (fps[i] ^ fps[j]).bit_count() <= radius])


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def cloud(seed, centres, members, flips=3):
    """Clouds of fingerprints around centres: chains and cliques within a few bits."""
    r, out = random.Random(seed), set()
    for _ in range(centres):
        c = r.getrandbits(64)
        out.add(c)
        for _ in range(members):
            x = r.choice(sorted(out)) if r.random() < 0.3 else c
            for _ in range(r.randint(1, flips)):
                x ^= 1 << r.randrange(64)
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("text", [
    "", " \n\t", "one", "Two Words", "ÄPFEL Äpfel äpfel A", "a b c d", prose(3, 400),
    "x\x0by\x0cz\x1cw same same same same", "  nbsp   em"])
def test_fingerprint(text):
    assert H.fingerprint(text) % (1 << 64) == brute_fingerprint(text)


def test_fingerprint_does_not_depend_on_blocks(monkeypatch):
    text = prose(8, 500)
    monkeypatch.setattr(H, "_BLOCK", 7)
    assert H.fingerprint(text) % (1 << 64) == brute_fingerprint(text)


def linked(spark, fps, parts, radius=2, bucket=H.BUCKET):
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    number = {signed(x): i for i, x in enumerate(fps)}
    got = [(number[r.a], number[r.b]) for r in H.links(df, parts, radius, bucket).collect()]
    assert all((fps[a] ^ fps[b]).bit_count() <= radius for a, b in got)
    return roots(len(fps), got)


@pytest.mark.parametrize("bucket", [1, 8, 10**6])
@pytest.mark.parametrize("shape", [
    [(32, 1), (32, 0)], [(21, 0), (21, 0), (22, 0)], [(64, 2)], [(10, -1), (54, 2)],
    [(16, 0), (16, 0), (16, 0), (16, -1)]])
def test_links_of_any_plan_give_the_same_components(spark, bucket, shape):
    bits = list(range(64))
    random.Random(4).shuffle(bits)
    parts = []
    for n, t in shape:
        if t >= 0:
            parts.append(H.Part(tuple(bits[:n]), t))
        bits = bits[n:]
    if shape == [(64, 2)] and bucket == 1:
        return  # the plan probes 2081 values each; once is enough
    fps = cloud(5, 12, 12)
    assert linked(spark, fps, parts, bucket=bucket) == brute_components(fps)


@pytest.mark.parametrize("radius", [0, 1, 3])
def test_star_links_of_other_radii(spark, radius):
    fps = cloud(6, 4, 10)
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    number = {signed(x): i for i, x in enumerate(fps)}
    got = [(number[r.a], number[r.b]) for r in H.star_links(df, radius).collect()]
    assert roots(len(fps), got) == brute_components(fps, radius)


def test_plan_covers_the_radius_and_groups_correlated_bits(spark):
    r = random.Random(7)
    fps = set()
    while len(fps) < 400:
        x = r.getrandbits(64)
        for b in range(0, 16, 2):  # bits 0..15 in equal pairs
            x = x & ~(1 << b + 1) | (x >> b & 1) << b + 1
        fps.add(x)
    df = spark.createDataFrame([(signed(x),) for x in sorted(fps)], "fp long")
    total, both = H.bit_statistics(df)
    assert total == 400
    assert both[3, 5] == sum(x >> 3 & 1 and x >> 5 & 1 for x in fps)
    assert all(any({b, b + 1} <= set(g) for g in H.group_bits(total, both, 4))
               for b in range(0, 16, 2))
    parts = H.plan(df)
    missing = 64 - sum(len(p.bits) for p in parts)
    assert sum(p.threshold + 1 for p in parts) == 2 + 1 and missing >= 0


def test_allocation_is_the_cheapest():
    costs = [[5.0, 9.0, 99.0], [1.0, 50.0, 60.0], [4.0, 4.5, 70.0], [2.0, 3.0, 80.0]]
    for radius in (1, 2):
        import itertools
        best = min(sum(c[t] for c, t in zip(costs, ts) if t >= 0)
                   for ts in itertools.product(range(-1, radius + 1), repeat=4)
                   if sum(ts) == radius - 3)
        assert H.allocate(costs, radius)[0] == best


def check(rows, got):
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    root = brute_components(fps)
    least = {}
    for k, (i, *_) in zip(root, rows):
        if i is not None:
            least[k] = min(i, least.get(k, i))
    want = sorted(((i, f"{f:016x}", least.get(k)) for (i, *_), f, k in zip(rows, fps, root)),
                  key=str)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == want


def near_copies(seed, n):
    r, base = random.Random(seed), prose(seed, 300).split()
    out = []
    for _ in range(n):
        w = list(base)
        w[r.randrange(len(w))] = "changed" + str(r.randrange(9))
        out.append(" ".join(w))
    return out


def test_groups(spark):
    rows = odd_rows() + [(100 + i, t) for i, t in enumerate(near_copies(1, 90))]
    rows += [(300 + i, prose(i % 20, 30)) for i in range(40)]
    check(rows, H.near_duplicate_groups(docs(spark, rows, CLASH)).collect())


def test_keep_one(spark):
    rows = odd_rows() + [(100 + i, t) for i, t in enumerate(near_copies(1, 30))]
    df = docs(spark, rows, CLASH)
    out = H.keep_one(df)
    assert out.columns == df.columns
    got = out.collect()
    root = brute_components([brute_fingerprint(t) for _, t, *_ in rows])
    assert len(got) == len(set(root))
    for k in set(root):
        members = [rows[i] for i in range(len(rows)) if root[i] == k]
        least = min((m[0] for m in members if m[0] is not None), default=None)
        assert sum((r.doc_id, r.text) in {(m[0], m[1]) for m in members if m[0] == least}
                   for r in got) == 1


def test_empty_table(spark):
    assert H.near_duplicate_groups(docs(spark, [])).collect() == []
    assert H.keep_one(docs(spark, [])).collect() == []


@pytest.mark.parametrize("links", [
    [(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 100)], [(5, 5), (1, 2), (2, 1)],
    [(random.Random(i).randrange(300), random.Random(-i - 1).randrange(300)) for i in range(250)], []])
def test_components(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    want = roots(300, links)
    touched = {x for a, b in links if a != b for x in (a, b)}
    assert got == {i: want[i] for i in touched}


def test_keep_one_leaves_caller_columns_alone(spark):
    df = docs(spark, [(1, prose(1, 50)), (2, prose(1, 50)), (3, prose(2, 50)),
                      (3, prose(2, 50))]).withColumn("_key", F.lit("mine"))
    got = H.keep_one(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id, r["_key"]) for r in got.collect()) == [(1, "mine"), (3, "mine")]
