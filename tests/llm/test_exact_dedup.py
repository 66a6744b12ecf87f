"""Exact dedup: recipes against grouping by the text, with and without hash clashes."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eventide.llm import exact_dedup as X
from tests.llm.data import CLASH, docs, odd_rows, prose


def brute(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=str)


def check(df, rows):
    got = df.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got),
                  key=str) == brute(rows)
    kept = [r.text_sha256 for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len({r[1] or "" for r in rows})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_odd_rows(spark):
    check(X.exact_groups(docs(spark, odd_rows(), CLASH)), odd_rows())


def test_shared_passages_are_not_copies(spark):
    a, b, c = prose(1, 900), prose(2, 900), prose(3, 900)
    rows = [(1, a + " " + b), (2, a + " " + c), (3, a + " " + b), (4, b + " " + a), (5, a)]
    check(X.exact_groups(docs(spark, rows)), rows)


@pytest.mark.parametrize("values", [1, 3])
def test_clashing_hashes_get_ranks(spark, values):
    rows = [(i, prose(i % 7, 300 + 100 * (i % 3))) for i in range(30)] + odd_rows()

    def weak(c):
        return F.pmod(F.xxhash64(c), F.lit(values))

    check(X.exact_groups(docs(spark, rows), chunk_hash=weak), rows)


def test_chunks_join_to_the_text(spark):
    texts = [prose(s, n) for s, n in ((1, 5000), (2, 3))] + ["x" * 20_000, "漢字" * 9000, "\n" * 999]
    df = docs(spark, list(enumerate(texts)))
    got = df.select("text", X.chunk_list(F.col("text")).alias("c")).collect()
    assert all("".join(r.c) == r.text for r in got)
    assert max(len(c) for r in got for c in r.c) <= X.MAX_CHUNK + 2


def test_a_shifted_passage_keeps_its_chunks(spark):
    a = prose(5, 4000)
    df = docs(spark, [(1, a), (2, "some words in front of it. " + a)])
    one, two = (set(r.c) for r in df.select(X.chunk_list(F.col("text")).alias("c")).collect())
    assert len(one & two) > 0.8 * len(one)


def test_empty_table(spark):
    assert X.exact_groups(docs(spark, [])).collect() == []
