"""The pipeline, stage by stage, against brute force on its own input."""

import os

import pytest

import corpus_pipeline as P
from eventide.llm import toxicity
from tests.conftest import SF001
from tests.llm import test_decontaminate as TD
from tests.llm import test_mixing as TM
from tests.llm import test_simhash_dedup as TS


def rows_of(df):
    return [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(os.path.join(SF001, "documents.parquet"))
    schema, frames = docs.schema, [docs]
    for name, stage in P.STAGES:
        path = str(tmp_path / name)
        stage(spark, frames[-1], SF001).write.parquet(path)
        frames.append(spark.read.parquet(path))
    assert all(f.schema == schema for f in frames[1:-1])
    start, clean, single, safe, mixed = map(rows_of, frames[:5])

    scored = toxicity.detect(docs, spark.read.parquet(os.path.join(SF001, "labels.parquet")))
    good = {r.doc_id for r in scored.collect() if r.score < 0.3}
    assert sorted(clean) == sorted(r for r in start if r[0] in good) and len(clean) < len(start)

    root = TS.brute_components([TS.brute_fingerprint(r[1]) for r in clean])
    least = {k: min(clean[i][0] for i in range(len(clean)) if root[i] == k) for k in set(root)}
    assert sorted(r[0] for r in single) == sorted(least.values()) and len(single) < len(clean)

    items = [(r.item_id, r.text) for r in
             spark.read.parquet(os.path.join(SF001, "benchmark.parquet")).collect()]
    hit = {i for i, _ in TD.brute(single, items)}
    assert sorted(r[0] for r in safe) == sorted(r[0] for r in single if r[0] not in hit) and hit

    from eventide.llm import mixing
    taken = mixing.mix(frames[3]).collect()
    TM.check(safe, taken)
    want = {r.doc_id: -(-r.taken // r["size"]) for r in taken if r.taken}
    got = {}
    for r in mixed:
        got[r[0]] = got.get(r[0], 0) + 1
    assert got == want
    assert frames[5].count() == len(mixed)
    assert {r.shard for r in frames[5].collect()} <= set(range(8))


def test_run(spark):
    a = sorted(map(tuple, P.run(spark, SF001).collect()))
    b = sorted(map(tuple, P.run(spark, SF001).collect()))
    assert a == b and len(a) > 50


@pytest.mark.parametrize("name, stage", P.STAGES)
def test_stages_take_an_empty_table(spark, name, stage):
    docs = spark.read.parquet(os.path.join(SF001, "documents.parquet")).where("false")
    assert stage(spark, docs, SF001).collect() == []
