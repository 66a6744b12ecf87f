"""Merkle manifest against a tree built in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from eventide.llm import merkle

from .data import CLASH, docs, odd_rows, prose


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row, lower=False):
    out = ""
    for k, v in enumerate(row):
        if lower and k == 4 and v is not None:
            v = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in v)
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(out)


def tree(nodes, fanout):
    """The root, and every node's list of (left, right) up to it."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + fanout] for i in range(0, len(nodes), fanout)]
        for p, i in enumerate(at):
            run, k = runs[i // fanout], i % fanout
            paths[p].append(("".join(run[:k]), "".join(run[k + 1:])))
        nodes, at = [sha("".join(r)) for r in runs], [i // fanout for i in at]
    return nodes[0], paths


def brute(rows, tampered, fanout=16):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subroots, inner = [], {}
    for name in names:
        own = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        top, paths = tree([leaf(r) for r in own], fanout)
        subroots.append(top)
        inner[name] = list(zip(own, paths, strict=True))
    if not subroots:
        return []
    root, beyond = tree(subroots, fanout)
    out = []
    for k, name in enumerate(names):
        for r, path in inner[name]:
            path = path + beyond[k]
            fold = leaf(r, tampered(r[0]))
            for a, b in path:
                fold = sha(a + fold + b)
            out.append((r[0], leaf(r), subroots[k], root, sha("".join(a + b for a, b in path)),
                        fold, fold == root))
    return sorted(out, key=str)


def fifth(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def run(df, **options):
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return sorted((tuple(r) for r in merkle.manifest(df, tampered=hit, **options)
                   .drop("path").collect()), key=str)


def rows_of(sizes):
    out, n = [], 0
    for name, size in sizes.items():
        for _ in range(size):
            out.append((n * 7 % 1000, f"Text {n} of " + prose(n, 3), "en", name))
            n += 1
    return out


def fields(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 2}, {"a": 16}, {"b": 17, "a": 1}, {None: 3, "": 2, "é": 16, "z": 257},
    {f"s{i}": 1 + i % 3 for i in range(40)}])
def test_trees_of_many_shapes(spark, sizes):
    df = docs(spark, rows_of(sizes))
    assert run(df) == brute(fields(df), fifth)


def test_deep_tree_with_a_small_fanout(spark):
    df = docs(spark, rows_of({"a": 70, "b": 9, "c": 1}))
    assert run(df, fanout=2) == brute(fields(df), fifth, 2)


def test_odd_rows_and_clashing_columns(spark):
    more = [(n, k) for n, k in CLASH] + [("group", "string"), ("rank", "string"),
                                         ("leaf", "string"), ("lo", "string"), ("n", "string"),
                                         ("wrong", "string"), ("f0", "string")]
    df = docs(spark, odd_rows(5_000), more)
    assert run(df) == brute(fields(df), fifth)


def test_empty_table(spark):
    assert run(docs(spark, [])) == []


def test_a_tampered_leaf_does_not_verify(spark):
    df = docs(spark, [(i, f"UPPER {i}" if i % 2 else f"lower {i}", "en", "a") for i in range(40)])
    got = merkle.manifest(df, tampered=F.lit(True)).collect()
    assert {r.doc_id % 2 for r in got if not r.verified} == {1}
    assert {r.doc_id % 2 for r in got if r.verified} == {0}  # lower-casing changes nothing there


def test_string_ids(spark):
    df = docs(spark, rows_of({"a": 30, "b": 2})).withColumn(
        "doc_id", F.concat(F.lit("https://example.org/"), F.col("doc_id").cast("string")))
    groups = {}
    for r in fields(df):
        groups.setdefault(r[1], []).append(r)
    got = {r.doc_id: r for r in merkle.manifest(df).collect()}
    for own in groups.values():
        own.sort(key=lambda r: r[0].encode())
        top, _ = tree([leaf(r) for r in own], 16)
        assert {got[r[0]].subroot for r in own} == {top}
    assert all(r.verified for r in got.values())


def test_texts_are_not_shuffled(spark):
    plan = merkle.manifest(docs(spark, rows_of({"a": 30})))._jdf.queryExecution().toString()
    assert "text" not in plan
