"""Language, toxicity and quality: held-out accuracy, and the models' parts by themselves."""

import itertools
import os
import zlib

import numpy as np
import pytest

from eventide.llm import langid, quality, toxicity
from eventide.llm.queries import QUERIES
from tests.conftest import SF01
from tests.llm.data import CLASH, docs, odd_rows, prose

SF1 = "/root/testdata/sf0.1"


def held(i, mod, rest):
    return zlib.crc32(str(i).encode() if i is not None else b"") % mod == rest


def table(spark, d, name):
    return spark.read.parquet(os.path.join(d, f"{name}.parquet"))


def test_language_held_out(spark):
    got = QUERIES["op1_language_id"](spark, SF01).collect()
    true = {r.doc_id: r.lang for r in table(spark, SF01, "documents").collect()}
    assert len(got) == len(true)
    assert all(r.held_out == held(r.doc_id, 4, 2) and 0 <= r.score <= 1 for r in got)
    test = [r for r in got if r.held_out]
    assert sum(r.lang_pred == true[r.doc_id] for r in test) / len(test) > 0.98


def binary(spark, name, label, mod, rest):
    got = QUERIES[name](spark, SF1).collect()
    true = {r.doc_id: r[label] for r in table(spark, SF1, "labels").collect()}
    assert len(got) == table(spark, SF1, "documents").count()
    assert all(r.held_out == held(r.doc_id, mod, rest) and 0 <= r.score <= 1
               and r.predicted == (r.score >= 0.3) for r in got)
    test = [(true[r.doc_id], r) for r in got if r.held_out and r.doc_id in true]
    good = [r.predicted == y for y, r in test]
    caught = [r.predicted for y, r in test if y == 1]
    return np.mean(good), np.mean(caught)


def test_toxicity_held_out(spark):
    right, caught = binary(spark, "op2_toxicity", "toxic", 4, 2)
    assert right > 0.98 and caught > 0.9


def test_quality_held_out(spark):
    right, caught = binary(spark, "op4_quality", "quality", 5, 0)
    assert right > 0.98 and caught > 0.98


# -- language ---------------------------------------------------------------------------------

def test_language_odd_rows(spark):
    rows = odd_rows() + [(100 + i, prose(i, 30) if i % 2 else "schön über früh " * 9,
                          "xx" if i % 2 else "de") for i in range(60)]
    got = langid.identify(docs(spark, rows, CLASH)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, r)
    assert (by[1].lang_pred, by[2].lang_pred, by[3].lang_pred, by[8].lang_pred) == ("und",) * 4
    assert by[1].score == 0.0
    assert by[101].lang_pred == "xx" and by[100].lang_pred == "de"
    assert len({(r.lang_pred, r.score) for r in got if r.doc_id == 6}) == 1


def test_nothing_to_learn(spark):
    assert langid.identify(docs(spark, [])).collect() == []
    got = langid.identify(docs(spark, [(1, "some text"), (2, None, "en")])).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}


def test_ngrams_are_counts_of_folded_text():
    def total(t):
        return int(langid.ngrams(t)[1].sum())
    assert total("") == total("?! 12") - total("?! 12") == 0
    assert not len(langid.ngrams("?! 12")[0])
    assert total("ab") == 4 + 3 + 2  # " ab ": 4, 3 and 2 n-grams
    same = [langid.ngrams(t) for t in ("Ab c", "  ab -- C!", "aB9c")]
    assert all((a == b).all() for x in same[1:] for a, b in zip(same[0], x))


def test_sparse_weights_and_temperature():
    r = np.random.default_rng(0)
    idf = np.ones(50)
    rows = []
    for _ in range(400):
        y = int(r.integers(2))
        seen = np.unique(np.concatenate([[y], r.integers(2, 50, 6)]))
        rows.append((seen, np.full(len(seen), len(seen) ** -0.5, dtype=np.float32), y))
    dense, sparse = (langid.fit_ftrl(rows, ["a", "b"], idf, l1=x) for x in (0.0, 0.5))
    assert (sparse.weights == 0).mean() > (dense.weights == 0).mean() + 0.2
    assert all(sparse.logits(s, x).argmax() == y for s, x, y in rows)
    z, y = np.array([[8.0, 0.0]] * 10), np.array([0] * 8 + [1] * 2)
    t = langid.calibrate(z, y)
    assert langid.softmax(z / t)[0, 0] == pytest.approx(0.8, abs=1e-3)


# -- toxicity ---------------------------------------------------------------------------------

def brute_marginals(e, moves):
    """All taggings of one chain, state O before and after it."""
    oo, ot, to, tt = moves
    cost = {(0, 0): oo, (0, 1): ot, (1, 0): to, (1, 1): tt}
    total, with_t = 0.0, np.zeros(len(e))
    for tags in itertools.product((0, 1), repeat=len(e)):
        path = (0, *tags, 0)
        w = np.exp(sum(cost[p] for p in zip(path, path[1:]))
                   + sum(x for x, t in zip(e, tags) if t))
        total += w
        with_t += w * np.array(tags)
    return with_t / total, np.log(total)


def test_forward_backward():
    r = np.random.default_rng(3)
    for n in (1, 2, 7):
        e, moves = r.normal(0, 3, (n, 4)), np.array([0.0, *r.normal(0, 2, 3)])
        odds, _, _, log_z = toxicity.forward_backward(e, moves)
        for j in range(4):
            want, z = brute_marginals(e[:, j], moves)
            assert odds[:, j] / (1 + odds[:, j]) == pytest.approx(want)
            assert log_z[j] == pytest.approx(z)
    padded = np.vstack([e, np.full((5, 4), -np.inf)])
    assert toxicity.marginals(padded, moves)[:7] == pytest.approx(
        toxicity.marginals(np.vstack([e, np.full((1, 4), -np.inf)]), moves)[:7])


def test_chains_without_features_need_no_pass():
    m = toxicity.Field({"=bad": 6.0}, -4.0, np.array([0.0, -1.0, -0.5, 0.5]))
    tokens = ["fine"] * 200 + ["BAD"] + ["fine"] * 100
    (n, places, p), (_, none, _), (_, again, q) = toxicity.tag([tokens, ["fine"] * 500, tokens], m)
    whole = toxicity.chains(m.emissions(tokens) + m.bias)
    want = toxicity.marginals(whole, m.moves).T.ravel()[:len(tokens)]
    assert p == pytest.approx(want[places]) and 200 in places
    assert places[p.argmax()] == 200
    assert n == len(tokens) and len(none) == 0
    assert (again == places).all() and (p == q).all()


def test_spans_and_states_cross_block_borders():
    m = toxicity.Field({"=bad": 3.0, "=vile": 6.0}, -4.0, np.array([0.0, -2.0, -2.5, 2.0]))

    def whole(tokens):
        return toxicity.marginals((m.emissions(tokens) + m.bias)[:, None], m.moves)[:, 0]

    found = []
    for at in (10, 60, 62, 63, 64, 126, 128):
        tokens = ["fine"] * 300
        tokens[at:at + 4] = ["bad", "bad", "bad", "bad"]
        tokens[250] = "vile"
        (n, places, p), = toxicity.tag([tokens], m)
        assert n == 300 and list(places) == list(range(300))
        assert p == pytest.approx(whole(tokens), rel=1e-9)
        found.append((p[at:at + 4] >= 0.5).tolist())
    assert all(x == found[0] for x in found)
    r = np.random.default_rng(7)
    texts = [list(r.choice(["fine", "bad", "vile"], n, p=[0.97, 0.02, 0.01]))
             for n in (0, 1, 63, 64, 65, 128, 500, 5000)] + [["fine"] * 70]
    for at_once in (1, 5, 8192):
        for tokens, (n, places, p) in zip(texts, toxicity.tag(texts, m, at_once), strict=True):
            assert n == len(tokens) and len(places) in (0, n)
            if len(places):
                assert p == pytest.approx(whole(tokens), rel=1e-9)
            else:
                assert set(tokens) <= {"fine"}


def toxic_rows():
    rows = [(i, prose(i, 40)) for i in range(160)]
    bad = {i for i in range(160) if i % 4 == 0}
    rows = [(i, t.replace(" ", " foul" + "abcdef"[i % 6] + "mouth ", 1 + i % 3) if i in bad else t)
            for i, t in rows]
    return rows, [(i, None, int(i in bad)) for i in range(160)]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_toxicity_spans_and_odd_rows(spark):
    rows, marks = toxic_rows()
    rows = rows + [(1000 + i if i is not None else None, t) for i, t, *_ in odd_rows()]
    rows += [(2000, "é\U0001f600 Foulzmouth, " + prose(4, 80))]  # an unseen form of the stem
    marks += [(None, None, 1), (1001, None, None), (5, None, 0), (99999, None, 1)]
    got = toxicity.detect(docs(spark, rows, CLASH), labels(spark, marks)).collect()
    assert len(got) == len(rows)
    texts = dict((i, t) for i, t, *_ in rows)
    for r in got:
        if r.doc_id is not None and r.doc_id < 160:
            assert r.predicted == (r.doc_id % 4 == 0)
            words = [texts[r.doc_id][s.start:s.end] for s in r.spans]
            assert len(words) == (1 + r.doc_id % 3 if r.predicted else 0)
            assert all(w.startswith("foul") for w in words)
        if r.doc_id == 2000:
            assert r.predicted == 1
            assert [texts[2000][s.start:s.end] for s in r.spans] in (["Foulzmouth"], [])
        if r.doc_id is not None and 1000 <= r.doc_id < 2000:
            assert r.predicted == 0 and r.spans == []


def test_reject_toxic(spark):
    rows, marks = toxic_rows()
    df = docs(spark, rows + [(None, None)], CLASH)
    out = toxicity.reject_toxic(df, labels(spark, marks))
    assert out.schema == df.schema
    assert {r.doc_id for r in out.collect()} == {i for i in range(160) if i % 4} | {None}


@pytest.mark.parametrize("marks, score", [([], 0.0), ([(1, 1, 0)], 0.25), ([(1, 1, 1)], 0.75)])
def test_toxicity_without_two_classes(spark, marks, score):
    got = toxicity.detect(docs(spark, [(1, "a text"), (2, None)]), labels(spark, marks)).collect()
    assert {(r.score, r.predicted) for r in got} == {(score, int(score >= 0.3))}
    assert toxicity.detect(docs(spark, []), labels(spark, marks)).collect() == []


# -- quality ----------------------------------------------------------------------------------

def test_quality_odd_rows(spark):
    rows = odd_rows() + [(100 + i, prose(i, 60) if i % 3 else "*** $$$ " * 50) for i in range(90)]
    marks = [(100 + i, int(i % 3 > 0), None) for i in range(90)] + [(None, 1, 1), (1, None, 1)]
    got = quality.classify(docs(spark, rows, CLASH), labels(spark, marks)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id is not None and r.doc_id >= 100:
            assert r.predicted == int((r.doc_id - 100) % 3 > 0)
    bare = quality.classify(docs(spark, rows), labels(spark, [])).collect()
    assert {r.score for r in bare} == {0.5}
    assert quality.classify(docs(spark, []), labels(spark, marks)).collect() == []


def test_statistics_are_defined_everywhere():
    for t in ("", " ", "\n", "a", "!", "\U0001f600", "x" * 10, prose(1, 5000)):
        s = quality.statistics(t)
        assert len(s) == len(quality.STATISTICS) and np.isfinite(s).all()


def test_flat_trees_are_the_trees():
    r = np.random.default_rng(1)
    x = r.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    m = quality.fit_trees(x, y, trees=30, depth=3)

    def walk(row):
        total = m.base
        for f, t, leaf in zip(m.feature, m.threshold, m.leaf):
            at = 0
            while at < len(f):
                at = 2 * at + 1 + (row[f[at]] > t[at])
            total += leaf[at - len(f)]
        return 1 / (1 + np.exp(-total))
    assert m.score(x[:50]) == pytest.approx([walk(v) for v in x[:50]])
    assert ((m.score(x) > 0.5) == y).mean() > 0.97
    one = quality.fit_trees(np.ones((5, 2)), np.ones(5))
    assert (one.score(np.zeros((2, 2))) > 0.5).all()


def test_tags_and_private_use_are_no_letters():
    from eventide.llm import langid
    assert not len(langid.ngrams("\U0001F3F4\U000E0067\U000E0062\U000E007F")[0])
    assert not len(langid.ngrams("\U000F0000 \U0010FFFD")[0])
    assert len(langid.ngrams("\U00020000")[0])
