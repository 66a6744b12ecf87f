"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, everything that is no letter becomes a single space, and all n-grams of 1
to 3 characters are hashed into ``BUCKETS`` features. A feature weighs (1 + ln tf) * idf, with
document frequencies counted over every training document; vectors have length 1. The regression
is trained by the follow-the-regularised-leader rule with L1 and L2 penalties (most weights end
at exactly zero) and its logits are divided by a temperature that a part of the sample kept
from training chooses by log loss.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import id_remainder
from eventide.llm.learning import bounded_sample, train
from eventide.sources.tables import spread

ORDERS = 3
BITS = 15
BUCKETS = 1 << BITS
#: The classifier is fitted on at most about this many documents of a language.
PER_LANGUAGE = 1500
CALIBRATION_SHARE = 0.2
UNDETERMINED = "und"


_TABLE: dict[str, np.ndarray] = {}  # made where it is needed, not sent with the code


def _letters(cp: np.ndarray) -> np.ndarray:
    """Which code points are letters."""
    if not _TABLE:
        _TABLE["alpha"] = np.array([chr(c).isalpha() for c in range(0x20000)] + [False])
    out = _TABLE["alpha"][np.minimum(cp, 0x20000)]
    beyond = np.flatnonzero(cp >= 0x20000)  # ideographs, tags, private use: rare, one by one
    out[beyond] = [chr(c).isalpha() for c in cp[beyond].tolist()]
    return out


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and their counts; both empty if the text has no letter."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
    c = np.where(_letters(cp), cp, np.uint32(0))
    c = np.concatenate([[np.uint32(0)], c, [np.uint32(0)]]).astype(np.uint32)
    c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]
    if len(c) < 2:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    g = c
    for order in range(1, ORDERS + 1):
        if order > 1:
            g = g[:-1] * np.uint32(1_000_003) + c[order - 1:]
        h = (g + np.uint32(order * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(2_654_435_761)
        h ^= h >> np.uint32(15)
        counts += np.bincount((h * np.uint32(2_246_822_519)) >> np.uint32(32 - BITS),
                              minlength=BUCKETS)
    seen = np.flatnonzero(counts)
    return seen, counts[seen]


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray          # per bucket
    weights: np.ndarray      # buckets x languages
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, seen: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[seen]
        norm = np.sqrt((x * x).sum())
        return (x / norm if norm > 0 else x).astype(np.float32)

    def logits(self, seen: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[seen] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        seen, counts = ngrams(text or "")
        if not len(seen):
            return UNDETERMINED, 0.0
        p = softmax(self.logits(seen, self.vector(seen, counts)) / self.temperature)
        k = int(p.argmax())
        return self.languages[k], float(p[k])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents with letters and, per bucket, how many of them hold it, over all of
    ``docs`` (text): each task counts its own, one row per bucket leaves it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(BUCKETS + 1, dtype=np.int64)
        for b in batches:
            for t in b.column(0):
                seen, _ = ngrams(t.as_py() or "")
                df[seen] += 1
                df[BUCKETS] += len(seen) > 0
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])],
                                         ["f", "n"])

    out = np.zeros(BUCKETS + 1)
    for r in (docs.select("text").mapInArrow(run, "f int, n long")
                  .groupBy("f").agg(F.sum("n").alias("n")).collect()):
        out[r.f] = r.n
    return int(out[BUCKETS]), out[:BUCKETS]


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], languages: list[str],
             idf: np.ndarray, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0,
             l1: float = 0.02, l2: float = 0.01, seed: int = 5) -> Model:
    """Follow-the-regularised-leader, one example at a time, with a rate of its own for every
    weight. ``rows``: (features, unit vector, language number)."""
    k = len(languages)
    z = np.zeros((len(idf) + 1, k))
    n = np.zeros_like(z)

    def weights(at) -> np.ndarray:
        zz = z[at]
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1)
                        / ((beta + np.sqrt(n[at])) / alpha + l2))

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            seen, x, y = rows[i]
            at, x = np.append(seen, len(idf)), np.append(x, 1.0)  # the last one is the bias
            w = weights(at)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            now = n[at]
            then = now + g * g
            z[at] += g - (np.sqrt(then) - np.sqrt(now)) / alpha * w
            n[at] = then
    w = weights(slice(None))
    return Model(languages, idf, w[:-1].astype(np.float32), w[-1])


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden section on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))
        return float(-np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean())

    lo, hi, phi = -3.0, 3.0, (5 ** 0.5 - 1) / 2
    while hi - lo > 1e-3:
        a, b = hi - phi * (hi - lo), lo + phi * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """Train on ``labelled`` (doc_id, text, lang; no nulls in lang). The regression sees at most
    about ``per_language`` documents of a language, picked by a hash of id and text; document
    frequencies count all rows. None if there is no text with letters."""
    docs, df = document_frequencies(labelled)
    if not docs:
        return None
    idf = np.log((1 + docs) / (1 + df)) + 1

    def learn(table: pa.Table) -> dict | None:
        languages = sorted(set(table["lang"].to_pylist()))
        number = {x: i for i, x in enumerate(languages)}
        base = Model(languages, idf, np.zeros((0, 0)), np.zeros(0))
        rows, kept = [], []
        for text, lang, at in zip(table["text"], table["lang"], table["_at"], strict=True):
            seen, counts = ngrams(text.as_py() or "")
            if len(seen):
                row = (seen, base.vector(seen, counts), number[lang.as_py()])
                (kept if at.as_py() < CALIBRATION_SHARE else rows).append(row)
        if not rows:
            rows, kept = kept, []
        if not rows:
            return None
        model = fit_ftrl(rows, languages, idf)
        if kept:
            z = np.array([model.logits(seen, x) for seen, x, _ in kept])
            model.temperature = calibrate(z, np.array([y for _, _, y in kept]))
        return vars(model)

    sample = bounded_sample(labelled, "lang", ["doc_id", "text"], per_language)
    state = train(sample.select("_at", "doc_id", "lang", "text"), learn)
    return Model(**state) if state else None


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` (doc_id, text, ...) with lang_pred and score. Texts that are null or have no
    letter, and all texts if there is no model, are ``und`` with score 0."""
    held = docs.sparkSession.sparkContext.broadcast(model and vars(model))
    keep = [f for f in docs.schema if f.name not in ("text", "lang_pred", "score")]
    at = docs.columns.index("text")
    names = [f.name for f in keep]
    places = [docs.columns.index(c) for c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**held.value) if held.value else None
        for b in batches:
            found = [m.predict(t.as_py()) if m else (UNDETERMINED, 0.0) for t in b.column(at)]
            cols = [b.column(k) for k in places]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array([x for x, _ in found], pa.string()),
                 pa.array([s for _, s in found], pa.float64())],
                [*names, "lang_pred", "score"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep]
                       + ["lang_pred string", "score double"])
    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", mod: int = 4, held_out: int = 2,
             per_language: int = PER_LANGUAGE) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    Rows whose crc32 of the id (as text; null: empty) modulo ``mod`` is ``held_out``, and rows
    without a language, teach nothing. Null texts and texts without letters are ``und`` with
    score 0, as are all rows if nothing can be learned; repeated rows are scored alike; an empty
    table gives no rows; texts of any length are read whole; other columns are not read.
    """
    rows = spread(docs.select(F.col(id_col).alias("doc_id"),
                              F.col(text_col).cast("string").alias("text"),
                              F.col(lang_col).cast("string").alias("lang")))
    rows = rows.withColumn("held_out", id_remainder("doc_id", mod) == held_out)
    model = fit(rows.where("not held_out and lang is not null").select("doc_id", "text", "lang"),
                per_language)
    return predict(rows.select("doc_id", "text", "held_out"), model)
