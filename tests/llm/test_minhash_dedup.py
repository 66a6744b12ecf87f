"""MinHash near-dedup against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventide.llm import minhash_dedup as M

from .data import CLASH, WORDS, docs, odd_rows, prose


def brute(rows):
    """doc position -> (set size, smallest id reachable)."""
    sets = [M.shingle_set(t or "") for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if M.similar(sets[i], sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return sorted(((r[0], len(s), least[find(i)], r[0] == least[find(i)])
                   for i, (r, s) in enumerate(zip(rows, sets, strict=True))), key=str)


def run(df, **options):
    return sorted((tuple(r) for r in M.near_duplicate_groups(df, **options).select(
        "doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def edited(text, r, share):
    words = text.split()
    for i in r.sample(range(len(words)), max(1, int(len(words) * share))):
        words[i] = r.choice(WORDS)
    return " ".join(words)


def planted(seed=3):
    r = random.Random(seed)
    rows, n = [], 0
    for base in range(8):
        text = prose(100 + base, r.choice([6, 30, 120, 400]))
        for _ in range(r.choice([1, 2, 5, 9])):
            rows.append((n, text))
            n += 1
            text = edited(text, r, r.choice([0.01, 0.04, 0.09])) if r.random() < 0.7 else text
    r.shuffle(rows)
    return rows


def test_components_are_those_of_all_pairs(spark):
    rows = planted()
    assert run(docs(spark, rows)) == brute(rows)


def test_many_members_of_other_components_in_small_cells(spark):
    # near copies of one text, many of them short of the threshold to each other
    r = random.Random(5)
    text = prose(7, 150)
    rows = [(i, edited(text, r, r.choice([0.03, 0.06, 0.12]))) for i in range(60)]
    rows += [(100 + i, prose(500 + i, 40)) for i in range(10)]
    assert run(docs(spark, rows), cell=7) == brute(rows)


def test_border_of_the_threshold(spark):
    # sets of 9 shingles: 8 of 10 in common is a link, one fewer is not
    a = "a b c d e f g h i j".split()
    rows = [(1, " ".join(a)), (2, " ".join([*a[:9], "z"])), (3, " ".join([*a[:8], "y", "x"]))]
    s = [M.shingle_set(t) for _, t in rows]
    assert M.similar(s[0], s[1]) and not M.similar(s[0], s[2])
    assert run(docs(spark, rows)) == brute(rows)


def test_odd_rows_and_clashing_columns(spark):
    rows = odd_rows(8_000)
    more = [(n, k) for n, k in CLASH if n != "text"] + [
        ("name", "string"), ("node", "string"), ("sig", "string"), ("n", "string")]
    assert run(docs(spark, rows, more)) == brute([r[:2] for r in rows])


def test_empty_table(spark):
    assert run(docs(spark, [])) == []


def test_single_words_and_words_alone(spark):
    rows = [(1, "Word"), (2, " word\t"), (3, "word word"), (4, "wörd"), (5, "WÖRD"), (6, "")]
    got = run(docs(spark, rows))
    assert got == brute(rows)
    assert got[1][2] == 1 and got[4][2] == 5  # only A-Z is lower-cased


def test_names_of_sets_are_verified(spark):
    prints = spark.createDataFrame(
        [(1, 7, 1), (2, 7, 2), (3, 7, 1), (4, 8, 1), (5, None, None)], "doc long, k1 long, k2 long")
    got = {r.doc: r.node for r in M.identify(prints).collect()}
    assert got[1] == got[3] and len({got[1], got[2], got[4]}) == 3 and got[5] is None


def test_prune_bound_is_the_posterior(spark):
    # the posterior of a uniform prior, integrated numerically
    x = np.linspace(0, 1, 200_001)
    for n in (40, 120):
        m = M.least_matches(n, 0.8, 1e-6)

        def posterior(m, n=n):
            y = x ** m * (1 - x) ** (n - m)
            return y[x >= 0.8].sum() / y.sum()
        assert posterior(m) >= 1e-6 * 0.98 > posterior(m - 1) * 0.98


@pytest.mark.parametrize("share", [0.3, 0.8])
def test_signatures_estimate_similarity(share):
    r = np.random.default_rng(1)
    family = M._family(200)
    hits = []
    for _ in range(60):
        both = r.integers(0, 1 << 63, int(200 * share), dtype=np.uint64)
        rest = r.integers(0, 1 << 63, 200 - len(both), dtype=np.uint64)
        half = len(rest) // 2
        a, b = (np.frombuffer(M.signature(np.sort(np.concatenate([both, x])), family), "<u2")
                for x in (rest[:half], rest[half:]))
        hits.append((a == b).mean())
    assert abs(np.mean(hits) - share) < 0.02
    assert np.std(hits) < 1.5 * np.sqrt(share * (1 - share) / 200)


def test_join_split_deals_hot_keys(spark):
    from eventide.llm.common import join_split
    left = spark.range(3000).select(F.col("id"), F.when(F.col("id") < 2500, 1).otherwise(
        F.col("id")).alias("k"))
    right = spark.range(2900).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        want = sorted(map(str, left.join(right, "k", how).collect()))
        assert sorted(map(str, join_split(left, right, "k", how).select("k", "id", "v")
                          .collect())) == want


def test_every_document_of_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert run(df) == brute(rows)


def test_pairs_short_of_the_threshold_do_not_leave_their_cell(spark, monkeypatch):
    """Texts that are each just short of the threshold to all others: the signatures rule none of
    the pairs out, and all of them were verified one by one."""
    r = random.Random(11)
    rows = []
    for i in range(70):  # 50 of 1,500 words changed: any two have a similarity of about 0.77
        words = [f"w{k}" for k in range(1500)]
        for k in r.sample(range(1500), 50):
            words[k] = f"x{i}-{k}"
        rows.append((i, " ".join(words)))
    seen, links = [], M.exact_links

    def counted(pairs, texts, percent):
        seen.append(pairs.count())
        return links(pairs, texts, percent)
    monkeypatch.setattr(M, "exact_links", counted)
    assert run(docs(spark, rows)) == brute(rows)
    assert sum(seen[2:]) < 2 * len(rows)  # after the leaders' two rounds


def test_sets_too_large_to_travel_as_hashes(spark, monkeypatch):
    monkeypatch.setattr(M, "HELD", 100)
    r = random.Random(5)
    rows = []
    for base, length in enumerate((90, 112, 150)):  # below, around and above it
        text = prose(70 + base, length)
        rows += [(100 * base + i, edited(text, r, r.choice([0.03, 0.06, 0.12]))) for i in range(25)]
    assert run(docs(spark, rows), cell=7) == brute(rows)


def test_shared_hashes_are_counted_in_parts():
    r = np.random.default_rng(1)
    one = np.unique(r.integers(0, 50, 20)).astype(np.uint64)
    others = [np.unique(r.integers(0, 60, n)).astype(np.uint64) for n in (1, 5, 30, 2, 40)]
    want = [len(np.intersect1d(one, o)) for o in others]
    assert M._shared(one, others).tolist() == M._shared(one, others, 7).tolist() == want


def test_sets_travel_only_to_cells_where_they_may_link(spark, monkeypatch):
    """Texts that share many buckets well below the threshold: the hashes of all their sets went
    to every one of those buckets."""
    r = random.Random(4)
    rows = []
    for base in range(6):
        for i in range(12):  # 45 of 400 words changed: any two have a similarity of about 0.47
            words = [f"w{base}-{k}" for k in range(400)]
            for k in r.sample(range(400), 45):
                words[k] = f"x{base}-{i}-{k}"
            rows.append((100 * base + i, " ".join(words)))
    rows.append((1000, edited(rows[0][1], r, 0.02)))  # and one link
    sent, compare = [], M.cell_survivors

    def counted(dealt, *args):
        sent.append(dealt.count())
        return compare(dealt, *args)
    monkeypatch.setattr(M, "cell_survivors", counted)
    assert run(docs(spark, rows)) == brute(rows)
    assert sum(sent) < len(rows)


@pytest.mark.parametrize("most,others", [(5, 1), (7, 0), (40, 3), (40, 30), (9, 9)])
def test_each_pair_of_components_meets_in_one_cell(spark, most, others):
    roots = {k: 1000 if k < most else 2000 + k % 3 for k in range(most + others + 2)}
    rows = [(7, k, root, 1000, len(roots), most) for k, root in roots.items()]
    mixed = spark.createDataFrame(rows, "bucket long, node long, root long, major long, "
                                        "size long, most long")
    cells, copies = {}, 0
    for d in M.dealt_cells(mixed, 10).collect():
        cells.setdefault((d.i, d.j), []).append(d)
        copies += d.main
    met = []
    for (i, j), members in cells.items():
        sides = [{m.node for m in members if m.chunk == c} for c in (i, j)]
        assert len(sides[0]) + (len(sides[1]) if i != j else 0) == len(members)
        met += [(min(x, y), max(x, y)) for x in sides[0] for y in sides[1]
                if (x < y or i != j) and roots[x] != roots[y]]
    want = [(x, y) for x in roots for y in roots if x < y and roots[x] != roots[y]]
    assert sorted(met) == sorted(want)
    if len(roots) > 10:  # the largest component is sent once a chunk of others, not to itself
        assert copies == most * -(-(others + 2) // 10)


@pytest.mark.parametrize("share", [0.0, 0.8])
def test_bits_of_sketches_agree_by_similarity(share):
    r = np.random.default_rng(2)
    for k, bits in ((M.ROWS * M.BANDS, 16), (M.WIDE, 8)):
        family, apart = M._family(k), []
        for size in (40, 400, 30_000):
            for _ in range(20 if size < 1000 else 2):
                both = r.integers(0, 1 << 63, int(size * share), dtype=np.uint64) * np.uint64(2)
                rest = r.integers(0, 1 << 63, size - len(both), dtype=np.uint64) * np.uint64(2)
                half = len(rest) // 2
                sigs = [M.signature(np.sort(np.concatenate([both, x])), family, bits)
                        for x in (rest[:half], rest[half:])]
                a, b = (np.array(w).view(np.uint64) for w in M.sketches(sigs, bits).to_pylist())
                apart.append(int(np.bitwise_count(a ^ b).sum()))
        assert abs(np.mean(apart) / k - (1 - share) / 2) < 0.03
        assert share or min(apart) > M.most_apart(k, 80, 1e-6)
        assert not share or max(apart) <= M.most_apart(k, 80, 1e-6)


def test_sketches_prune_within_the_bound():
    for k in (M.ROWS * M.BANDS, M.WIDE):
        most = M.most_apart(k, 80, 1e-6)
        assert M.least_matches(k, 0.9, 1e-6) == k - most
        # a similarity of 0.8 leaves a tenth of the bits apart
        assert k / 10 < most < k / 4


def test_many_pairs_go_by_sketches_first(spark, monkeypatch):
    seen, promising = [], M.promising
    monkeypatch.setattr(M, "PAIRS", 2)
    monkeypatch.setattr(M, "promising", lambda *args: seen.append(1) or promising(*args))
    rows = planted()
    assert run(docs(spark, rows)) == brute(rows)
    assert seen
