"""License scans against exact containment over all of a text."""

import random
import re

import pytest

from eventide.llm import license_scan as L
from tests.llm.data import CLASH, docs, odd_rows, prose


def words(t):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").lower())


def shingle_list(t):
    w = words(t)
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]


def test_planted_notices_are_found_and_spans_cover_them(spark):
    r = random.Random(4)
    names = sorted(L.TEMPLATES)
    rows, want = odd_rows(), set()
    for n in range(120):
        name = names[n % len(names)]
        w = prose(n, 300).split()
        at = r.randrange(300)
        text = L.TEMPLATES[name]
        w[at:at] = [text.upper() if n % 3 == 0 else text.replace(" ", "\n# ") if n % 3 == 1 else text]
        rows.append((100 + n, ("é " if n % 2 else "") + " ".join(w)))
        want.add((100 + n, name))
    got = L.scan_licenses(docs(spark, rows, CLASH)).collect()
    # a notice that contains another one's line names both
    assert want <= {(r.doc_id, r.license) for r in got}
    texts = {i: t for i, t, *_ in rows}
    for g in got:
        assert g.containment >= 0.8
        span = set(shingle_list(texts[g.doc_id].lower()[g.start:g.end]))
        t = set(shingle_list(L.TEMPLATES[g.license]))
        assert len(span & t) / len(t) == pytest.approx(g.containment)
    assert all(len(set(shingle_list(texts[g.doc_id])) & set(shingle_list(L.TEMPLATES[g.license])))
               >= 0.8 * len(set(shingle_list(L.TEMPLATES[g.license]))) for g in got)
    assert {g.doc_id for g in got} == {i for i, _ in want}


def test_damaged_copies(spark):
    base = prose(77, 60)
    w = base.split()
    one = w[:30] + ["x"] + w[31:]          # 51 of 56 shingles
    many = [x if i % 5 else "x" for i, x in enumerate(w)]
    cut = w[:52]                           # 48 of 56: 0.857
    short = w[:40]
    rows = [(i, prose(i, 90) + " " + " ".join(t) + " " + prose(-i - 1, 90))
            for i, t in enumerate([w, one, many, cut, short])]
    got = {r.doc_id: r.containment for r in L.scan_licenses(docs(spark, rows), {"t": base}).collect()}
    assert got == {0: 1.0, 1: pytest.approx(51 / 56), 3: pytest.approx(48 / 56)}


@pytest.mark.parametrize("size", [5, 6, 9, 13, 21, 40, 200])
def test_every_offset(size):
    text = prose(size, size)
    index = L.Index({"t": text})
    for at in range(0, 70):
        found = index.scan(prose(1, at) + " " + text + " " + prose(2, 50))
        assert [m["containment"] for m in found] == [1.0], at


def test_band_guarantee():
    j = 0.4 / 2.1
    assert 1 - (1 - j) ** L.BANDS > 0.9999


def test_unusable_templates():
    with pytest.raises(ValueError):
        L.Index({"short": "too few words"})
    with pytest.raises(ValueError):
        L.Index({"long": "x " * (L.MAX_TEMPLATE_CHARS // 2 + 1)})
    assert L.Index({}).scan("any text of at least five words") == []


def test_empty_table(spark):
    assert L.scan_licenses(docs(spark, [])).collect() == []


def test_every_copy_gives_a_span(spark):
    line, grant = "Released under the MIT License.", L.TEMPLATES["ISC (grant)"]
    rows = [(1, f"{line} {prose(1, 3)} {line}\n{line}"), (2, f"{prose(2, 50)} {grant}{grant}"),
            (3, " ".join([line] * 40))]
    got = {}
    for r in L.scan_licenses(docs(spark, rows)).collect():
        got.setdefault((r.doc_id, r.license), []).append((r.start, r.end, r.containment))
    assert {k: len(v) for k, v in got.items()} == {
        (1, "MIT (line)"): 3, (2, "ISC (grant)"): 2, (3, "MIT (line)"): 40}
    texts = dict(rows)
    for (i, name), spans in got.items():
        spans.sort()
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
        for start, end, v in spans:
            assert v == 1.0 and words(texts[i][start:end]) == words(L.TEMPLATES[name])


def test_every_template_finds_itself():
    index = L.Index(L.TEMPLATES)
    for name, text in L.TEMPLATES.items():
        assert [m["containment"] for m in index.scan(f"{prose(3, 20)} {text} {prose(4, 20)}")
                if m["license"] == name] == [1.0]
