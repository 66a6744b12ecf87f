"""Quality: histogram gradient-boosted trees over document statistics.

Statistics of the whole text are taken once, in the tasks that read it, and written as a narrow
table; training and scoring read only that. Trees are complete, of fixed depth, and flattened
into arrays (feature, threshold, leaf value), so a batch of documents descends a tree in one
numpy step per level.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import hash_fraction, id_and_text, id_remainder, materialise
from eventide.llm.learning import taught_labels, train

STATISTICS = (
    "log_bytes", "log_words", "word_length", "distinct_words", "distinct_pairs", "repeated_next",
    "top_word", "upper", "digit", "space", "sentence_end", "comma", "other_symbol", "not_ascii",
    "byte_entropy", "log_lines", "line_length", "distinct_lines", "words_without_letter",
    "words_ending_in_symbol", "one_symbol_words", "capital_words")
#: The trees are fitted on at most about this many labelled documents.
MAX_ROWS = 20_000

_CLASSES = np.zeros((256, 7))
for _b in range(256):
    _c = chr(_b)
    _k = (0 if "A" <= _c <= "Z" else 1 if "0" <= _c <= "9" else 2 if _c in " \t\n\r\v\f"
          else 3 if _c in ".!?" else 4 if _c in ",;:" else 6 if _b >= 128
          else 5 if not ("a" <= _c <= "z") else None)
    if _k is not None:
        _CLASSES[_b, _k] = 1
_SYMBOLS = set("!\"#$%&'()*+-/<=>@[\\]^_`{|}~")


def statistics(text: str) -> list[float]:
    """The numbers named in STATISTICS; all 0 for an empty text."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    if not len(raw):
        return [0.0] * len(STATISTICS)
    counts = np.bincount(raw, minlength=256)
    n = len(raw)
    p = counts[counts > 0] / n
    upper, digit, space, end, comma, other, high = (counts @ _CLASSES) / n
    words = text.split()
    w = max(len(words), 1)
    pairs = max(len(words) - 1, 1)
    seen = Counter(words)
    lines = text.split("\n")
    forms = len(seen)
    kinds = [(not any(map(str.isalpha, x)), x[-1] in _SYMBOLS, len(x) == 1 and x in _SYMBOLS,
              x[0].isupper(), c) for x, c in seen.items()]
    without, ending, single, capital = (sum(k[i] * k[4] for k in kinds) / w for i in range(4))
    return [
        float(np.log1p(n)), float(np.log1p(len(words))), (n - counts[32]) / w, forms / w,
        len(set(zip(words, words[1:], strict=False))) / pairs,
        sum(map(operator.eq, words, words[1:])) / pairs,
        max(seen.values(), default=0) / w, upper, digit, space, end, comma, other, high,
        float(-(p * np.log2(p)).sum()), float(np.log1p(len(lines))),
        float(np.log1p(n / len(lines))), len(set(lines)) / len(lines), without, ending, single,
        capital]


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and stats (an array of doubles) of every row of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stats = pa.array([statistics(t.as_py()) for t in b.column(1)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), stats], ["doc_id", "stats"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, stats array<double>")


@dataclass
class Trees:
    """``feature`` and ``threshold`` hold a tree's inner nodes in level order (trees x inner),
    ``leaf`` its leaves; a row goes right where its value is above the threshold."""
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            while inner and at[0] < inner:  # all rows are on the same level
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            total += leaf[at - inner]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64,
              rate: float = 0.15, l2: float = 1.0, min_hessian: float = 2.0) -> Trees:
    """Second-order boosting for log loss. Values are cut at quantiles into ``bins``; a split is
    found from gradient and hessian histograms, one pass per level and feature."""
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left")
                       for j, c in enumerate(cuts)], axis=1)
    prior = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(prior / (1 - prior)))
    inner, leaves = 2 ** depth - 1, 2 ** depth
    feature = np.zeros((trees, inner), dtype=np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, leaves))
    margin = np.full(n, base)
    for k in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        at = np.zeros(n, dtype=np.int64)  # node within the level
        for level in range(depth):
            nodes, first = 2 ** level, 2 ** level - 1
            total_g = np.bincount(at, grad, nodes)
            total_h = np.bincount(at, hess, nodes)
            best = np.full(nodes, 1e-6)
            for j in range(m):
                width = len(cuts[j]) + 1
                if width < 2:
                    continue
                cell = at * width + binned[:, j]
                g = np.bincount(cell, grad, nodes * width).reshape(nodes, width)
                h = np.bincount(cell, hess, nodes * width).reshape(nodes, width)
                gl, hl = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
                gr, hr = total_g[:, None] - gl, total_h[:, None] - hl
                gain = (gl ** 2 / (hl + l2) + gr ** 2 / (hr + l2)
                        - (total_g ** 2 / (total_h + l2))[:, None])
                gain[(hl < min_hessian) | (hr < min_hessian)] = -1
                cut = gain.argmax(1)
                got = gain[np.arange(nodes), cut]
                for node in np.flatnonzero(got > best):
                    best[node] = got[node]
                    feature[k, first + node] = j
                    threshold[k, first + node] = cuts[j][cut[node]]
            f, t = feature[k, first + at], threshold[k, first + at]
            at = 2 * at + (x[np.arange(n), f] > t)
        g, h = np.bincount(at, grad, leaves), np.bincount(at, hess, leaves)
        leaf[k] = -rate * g / (h + l2)
        margin += leaf[k][at]
    return Trees(feature, threshold, leaf, base)


def fit(stats: DataFrame, taught: DataFrame, max_rows: int = MAX_ROWS) -> Trees | None:
    """Trees from ``stats`` (doc_id, stats) and the labels ``taught`` (doc_id, label 0/1; unique
    ids), of which at most about ``max_rows``, picked by a hash of the id, are used: few enough
    to broadcast. Of several rows with one id one counts. None without rows."""
    share = min(1.0, max_rows / max(1, taught.count()))
    ids = taught.where(hash_fraction(F.col("doc_id"), seed=17) < share)
    sample = (stats.join(F.broadcast(ids), "doc_id").groupBy("doc_id")
                   .agg(F.first("label").alias("label"), F.min("stats").alias("stats")))

    def learn(table: pa.Table) -> dict:
        x = np.array(table["stats"].to_pylist(), dtype=np.float64)
        return vars(fit_trees(x, table["label"].to_numpy().astype(np.float64)))

    state = train(sample.select("doc_id", "label", "stats"), learn)
    return Trees(**state) if state else None


def score(stats: DataFrame, trees: Trees | None, cut: float = 0.3) -> DataFrame:
    """``stats`` (doc_id, stats) to doc_id, score, predicted; without trees every score is 0.5."""
    held = stats.sparkSession.sparkContext.broadcast(trees and vars(trees))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Trees(**held.value) if held.value else None
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            s = m.score(x) if m else np.full(b.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(s), pa.array((s >= cut).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.select("doc_id", "stats").mapInArrow(
        run, f"doc_id {kind}, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "quality", mod: int = 5,
             held_out: int = 0, max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 from score 0.3 on).

    Labels of rows whose crc32 of the id (as text; null: empty) modulo ``mod`` is ``held_out``,
    and null labels, teach nothing; of several labels of an id the largest counts. Null texts
    count as empty, and empty texts are scored like any other. Without labels every score is
    0.5. Repeated rows are scored alike; an empty table gives no rows; texts of any length are read
    whole; other columns are not read.
    """
    stats = materialise(document_statistics(id_and_text(docs, id_col, text_col)), "doc-stats")
    taught = taught_labels(labels, id_col, label_col, mod, held_out)
    trees = fit(stats, taught, max_rows)
    return score(stats, trees).select(
        "doc_id", (id_remainder("doc_id", mod) == held_out).alias("held_out"), "score",
        "predicted")
