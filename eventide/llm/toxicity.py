"""Toxicity: a linear-chain conditional random field tags toxic spans.

Tokens are runs of letters, digits, marks and underscores. Each token is clean (O) or toxic (T),
with features of its lower-cased form (the form, its prefixes and suffixes) and weights for the
change between neighbours. A text's tokens are one chain; before it and after it the state is O.

Labels come per document, so training tokens are labelled first: a feature whose documents are
toxic far more often than the others marks, in a toxic document, its tokens T; every other token
is O. The field is then trained by gradient ascent on the log likelihood. Training, other than
scoring, cuts the tokens into chains of ``CHAIN`` with state O around each.

Scoring runs forward-backward over the whole chain of every text that holds a token with a
weighted feature: the transfer of each block of ``CHAIN`` tokens gives the state at its borders,
then all blocks go through one pass. (All other texts count as one token without a feature.) A
document's score is a logistic
function, fitted on the labelled sample, of its largest marginal and of the expected number of
toxic tokens; offending offsets are the tokens with a marginal of at least one half.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import id_and_text, id_remainder
from eventide.llm.learning import bounded_sample, taught_labels, train

CHAIN = 64
TOKEN = re.compile(r"\w+")
PREFIXES, SUFFIXES = (3, 4, 5, 6), (4, 5)
#: The field is fitted on at most about this many labelled documents of each class.
PER_CLASS = 1500
#: A feature marks tokens if it is in this many times more toxic than clean documents, in
#: relation to their numbers, and in this share of the toxic ones (three at least).
MARK_RATIO, MARK_SHARE, MARK_DOCS = 20.0, 0.01, 3
#: A token is an offending one from this marginal on.
SPAN_CUT = 0.5
PREDICT_CUT = 0.3


def token_features(token: str) -> list[str]:
    w = token.lower()
    out = ["=" + w]
    out += ["<" + w[:k] for k in PREFIXES if len(w) >= k]
    out += [">" + w[-k:] for k in SUFFIXES if len(w) >= k]
    return out


@dataclass
class Field:
    weights: dict[str, float]   # log weight of T over O, by feature
    bias: float                 # of T over O, for every token
    moves: np.ndarray           # log weights: O to O (0), O to T, T to O, T to T
    scale: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0, 0.0]))
    _seen: dict[str, float] = field(default_factory=dict)  # forms met before

    def __post_init__(self) -> None:
        # a form can only have a weight if it begins or ends like one that has
        self._heads = {f[1:4] for f in self.weights if f[0] != ">"}
        self._tails = {f[-min(SUFFIXES):] for f in self.weights if f[0] == ">"}

    def state(self) -> dict:
        return {k: v for k, v in vars(self).items() if k[0] != "_"}

    def weight(self, token: str) -> float:
        w = token.lower()
        if w[:3] not in self._heads and w[-min(SUFFIXES):] not in self._tails:
            return 0.0
        get = self.weights.get
        return sum(get(f, 0.0) for f in token_features(w))

    def emissions(self, tokens: list[str]) -> np.ndarray:
        """Summed feature weights per token; most are 0. Forms met lately are remembered."""
        seen = self._seen
        if len(seen) > 100_000:
            seen.clear()
        out = list(map(seen.get, tokens))
        if None in out:
            for i, e in enumerate(out):
                if e is None:
                    out[i] = seen[tokens[i]] = self.weight(tokens[i])
        return np.array(out, dtype=np.float64)


def forward_backward(e: np.ndarray, moves: np.ndarray, before: np.ndarray | None = None,
                     after: np.ndarray | None = None):
    """Odds of T at each place of chains ``e`` (places x chains: log weight of T over O; minus
    infinity beyond a chain's end), the odds of the forward and backward parts, and the log of
    each chain's sum over all taggings. Odds stay in range as weights are clipped. ``before`` and
    ``after`` are the forward odds ahead of the chains and the backward odds at their last places,
    if they are parts of longer ones."""
    oo, ot, to, tt = np.exp(moves)
    w = np.exp(np.clip(e, -30, 30))
    w[np.isneginf(e)] = 0.0
    n = len(e)
    fwd, bwd = np.empty_like(w), np.empty_like(w)
    r = np.zeros(w.shape[1]) if before is None else before  # state O before the chain
    log_z = np.zeros(w.shape[1])
    for t in range(n):
        down = oo + r * to
        log_z += np.log(down)
        r = w[t] * (ot + r * tt) / down
        fwd[t] = r
    log_z += np.log(oo + r * to)      # and O after it
    s = np.full(w.shape[1], to / oo) if after is None else after
    for t in range(n - 1, -1, -1):
        bwd[t] = s
        up = w[t] * s
        s = (to + tt * up) / (oo + ot * up)
    return fwd * bwd, fwd, bwd, log_z


def marginals(e: np.ndarray, moves: np.ndarray) -> np.ndarray:
    odds = forward_backward(e, moves)[0]
    return odds / (1 + odds)


def chains(values: np.ndarray) -> np.ndarray:
    """A sequence as one chain, whatever its length: places x 1."""
    return values.reshape(-1, 1)


def transfers(e: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """What each part of a chain (places x parts) makes of the weights of O and T before it:
    (O to O, O to T, T to O, T to T) x parts, up to a factor."""
    oo, ot, to, tt = np.exp(moves)
    w = np.exp(np.clip(e, -30, 30))
    w[np.isneginf(e)] = 0.0
    a, b = np.ones(e.shape[1]), np.zeros(e.shape[1])
    c, d = b.copy(), a.copy()
    for x in w:
        a, b = oo * a + to * b, x * (ot * a + tt * b)
        c, d = oo * c + to * d, x * (ot * c + tt * d)
        z = a + b + c + d
        a, b, c, d = a / z, b / z, c / z, d / z
    return np.array([a, b, c, d])


def tag(docs: Iterable[list[str]], model: Field,
        at_once: int = 8192) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each document its number of tokens, and, if any has a weighted feature, the places of
    all its tokens and their marginals in the chain of the whole document. Documents go through
    one pass together until they have ``at_once`` blocks."""
    held, blocks = [], 0
    for tokens in docs:
        held.append(model.emissions(tokens))
        blocks += -(-len(tokens) // CHAIN) if held[-1].any() else 0
        if blocks >= at_once:
            yield from _tag(held, model)
            held, blocks = [], 0
    yield from _tag(held, model)


def _tag(docs: list[np.ndarray], model: Field) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    oo, _, to, _ = np.exp(model.moves)
    # column 0 is a block without a feature; all such blocks share its transfer, and those with
    # the same states around them their marginals
    columns, of_doc = [np.full(CHAIN, model.bias)], []
    for e in docs:
        of_doc.append([])
        if e.any():
            n = -(-len(e) // CHAIN)
            x = np.full(n * CHAIN, -np.inf)
            x[:len(e)] = e + model.bias
            x = x.reshape(n, CHAIN)
            own = np.add.reduceat(e != 0, np.arange(0, len(e), CHAIN)) > 0
            own[-1] = True
            for k in range(n):
                of_doc[-1].append(len(columns) if own[k] else 0)
                if own[k]:
                    columns.append(x[k])
    e = np.array(columns).T
    step = transfers(e, model.moves).T.tolist()
    parts: dict[tuple, int] = {}
    of_part = []
    for blocks in of_doc:
        before, after = [0.0], [to / oo]
        for k in blocks[:-1]:
            a, b, c, d = step[k]
            before.append((b + d * before[-1]) / (a + c * before[-1]))
        for k in blocks[:0:-1]:
            a, b, c, d = step[k]
            after.append((c + d * after[-1]) / (a + b * after[-1]))
        of_part.append([parts.setdefault(x, len(parts))
                        for x in zip(blocks, before, reversed(after))])
    if parts:
        column, before, after = (np.array(x) for x in zip(*parts))
        odds = forward_backward(e[:, column], model.moves, before, after)[0]
        p = (odds / (1 + odds)).T
    for x, part in zip(docs, of_part, strict=True):
        n = len(x)
        yield (n, np.arange(n), p[part].ravel()[:n]) if part else (
            n, np.arange(0), np.empty(0))


def summary(p: np.ndarray, model: Field, tokens: int) -> tuple[float, float]:
    """What a document's score reads: the log odds of the largest marginal, and the logarithm
    of 1 + the expected number of toxic tokens among the offending ones."""
    plain = 0.0 if not tokens else float(marginals(np.full((1, 1), model.bias), model.moves)[0, 0])
    top = min(max(float(p.max(initial=plain)), 1e-6), 1 - 1e-6)
    return float(np.log(top / (1 - top))), float(np.log1p(p[p >= SPAN_CUT].sum()))


def document_score(p: np.ndarray, model: Field, tokens: int) -> float:
    x = np.array([1.0, *summary(p, model, tokens)])
    return float(1 / (1 + np.exp(-np.clip(model.scale @ x, -30, 30))))


# -- training -----------------------------------------------------------------------------

def _tokens(texts: Iterable[str]) -> Iterator[list[str]]:
    return (TOKEN.findall(t) for t in texts)


def _found(tokens: Iterable[str]) -> set[str]:
    return {f for t in set(map(str.lower, tokens)) for f in token_features(t)}


def distinct_texts(texts: Sequence[str], bands: int = 6, rows: int = 2) -> list[int]:
    """Places of the texts that are no near copy of an earlier one: copies share all their
    words, so any word of a large group of copies would look like a mark. Near copies meet in
    one of ``bands`` pairs of least hashes of three-token runs."""
    seeds = np.random.default_rng(11).integers(1, 2**63, bands * rows, dtype=np.uint64) | 1
    met: set[tuple[int, ...]] = set()
    out = []
    for i, tokens in enumerate(_tokens(texts)):
        h = np.array([zlib.crc32(t.lower().encode()) for t in tokens] or [0], dtype=np.uint64)
        for _ in range(2 if len(h) > 2 else 0):  # runs of three tokens
            h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
        least = [int(((h * s) >> np.uint64(20)).min()) for s in seeds]
        keys = {(b, *least[b * rows:(b + 1) * rows]) for b in range(bands)}
        if met.isdisjoint(keys):
            out.append(i)
        met |= keys
    return out


def marking_features(texts: Sequence[str], toxic: np.ndarray) -> set[str]:
    """Features whose presence in a document speaks strongly for label 1. Most features are
    rare: hashed counts over the toxic texts say which can reach the least count at all, and
    only those are counted by name. Texts are read again for each count, not kept as tokens."""
    n1, n0 = int(toxic.sum()), int(len(toxic) - toxic.sum())
    least = max(MARK_DOCS, MARK_SHARE * n1)
    bad = [t for t, y in zip(texts, toxic, strict=True) if y]
    rough = np.zeros(1 << 20, dtype=np.int32)

    def bucket(f: str) -> int:
        return zlib.crc32(f.encode()) & 0xFFFFF

    for tokens in _tokens(bad):
        rough[np.unique([bucket(f) for f in _found(tokens)]).astype(np.int64)] += 1
    with_f = Counter()
    for tokens in _tokens(bad):
        with_f.update(f for f in _found(tokens) if rough[bucket(f)] >= least)
    with_f = {f: a for f, a in with_f.items() if a >= least}
    without_f = Counter()
    for tokens in _tokens(t for t, y in zip(texts, toxic, strict=True) if not y):
        without_f.update(with_f.keys() & _found(tokens))
    return {f for f, a in with_f.items()
            if (a / n1) / ((without_f[f] + 0.5) / (n0 + 1)) >= MARK_RATIO}


def weighted_features(texts: Sequence[str], toxic: np.ndarray, marks: set[str]) -> list[str]:
    """Features that get a weight: of at least ``MARK_DOCS`` tokens labelled T, and of not ten
    times as many labelled O. The bias speaks for all others."""
    t_count, every = Counter(), Counter()
    for tokens, y in zip(_tokens(texts), toxic, strict=True):
        if y:
            for x in tokens:
                fs = token_features(x)
                if not marks.isdisjoint(fs):
                    t_count.update(fs)
    names = {f for f, n in t_count.items() if n >= MARK_DOCS}
    for tokens in _tokens(texts):
        every.update(f for x in tokens for f in token_features(x) if f in names)
    return sorted(f for f in names if every[f] <= 10 * t_count[f])


def fit_field(texts: Sequence[str], toxic: np.ndarray, rounds: int = 80, rate: float = 0.3,
              l2: float = 1.0) -> Field:
    """Mark tokens, then climb the chains' log likelihood with per-weight adaptive steps."""
    marks = marking_features(texts, toxic)
    names = weighted_features(texts, toxic, marks)
    number = {f: i for i, f in enumerate(names)}
    # chains without any weighted feature look alike but for their length: count, don't repeat
    alike: Counter = Counter()
    places, feats, rows, gold = [], [], [], []
    used = 0
    for tokens, y in zip(_tokens(texts), toxic, strict=True):
        for lo in range(0, len(tokens), CHAIN):
            c = tokens[lo:lo + CHAIN]
            found, t = [], np.zeros(len(c), dtype=bool)
            for k, x in enumerate(c):
                fs = token_features(x)
                t[k] = bool(y) and not marks.isdisjoint(fs)
                found += [(k, number[f]) for f in fs if f in number]
            if not found:
                alike[len(c)] += 1
                continue
            places += [k for k, _ in found]
            feats += [i for _, i in found]
            rows += [used] * len(found)
            gold.append((len(c), t))
            used += 1
    for n, _ in sorted(alike.items()):
        gold.append((n, np.zeros(n, dtype=bool)))
    weight = np.concatenate([np.ones(used), [v for _, v in sorted(alike.items())]])
    m = len(gold)
    if not m or not names:
        return Field({}, -9.0, np.zeros(4))
    inside = np.zeros((CHAIN, m), dtype=bool)
    truth = np.zeros((CHAIN, m), dtype=bool)
    for j, (n, t) in enumerate(gold):
        inside[:n, j] = True
        truth[:len(t), j] = t
    at, col, feats = np.array(places, int), np.array(rows, int), np.array(feats, int)
    before = np.vstack([np.zeros((1, m), dtype=bool), truth])   # O before the chain
    after = np.vstack([truth, np.zeros((1, m), dtype=bool)])    # O after it
    steps = np.vstack([inside, np.zeros((1, m), dtype=bool)])
    steps[1:] |= inside                                          # also the step out of the end
    seen_moves = np.array([0.0] + [float(((before == a) & (after == b) & steps).sum(0) @ weight)
                                   for a, b in ((False, True), (True, False), (True, True))])
    seen_bias = float(truth.sum(0) @ weight)
    seen_feats = np.bincount(feats, truth[at, col] * weight[col], len(names))
    theta = np.zeros(len(names) + 4)  # features, bias, moves OT TO TT
    theta[len(names)] = -2.0
    grad2 = np.full(len(theta), 1e-6)
    for _ in range(rounds):
        moves = np.array([0.0, *theta[-3:]])
        e = np.where(inside, theta[len(names)], -np.inf)
        np.add.at(e, (at, col), theta[feats])
        odds, fwd, bwd, _ = forward_backward(e, moves)
        p = odds / (1 + odds)
        oo, ot, to, tt = np.exp(moves)
        w = np.exp(np.clip(e, -30, 30))
        w[~inside] = 0.0
        r = np.vstack([np.zeros((1, m)), fwd])
        ws = np.vstack([w * bwd, np.zeros((1, m))])
        j_oo, j_ot, j_to, j_tt = oo + 0 * r, ot * ws, to * r, tt * r * ws
        z = j_oo + j_ot + j_to + j_tt
        expect = np.array([0.0] + [float((np.where(steps, j / z, 0.0)).sum(0) @ weight)
                                   for j in (j_ot, j_to, j_tt)])
        g = np.concatenate([
            seen_feats - np.bincount(feats, p[at, col] * weight[col], len(names)),
            [seen_bias - float(np.where(inside, p, 0.0).sum(0) @ weight)],
            (seen_moves - expect)[1:]])
        g[:len(names)] -= l2 * theta[:len(names)]
        g[-3:] -= l2 * theta[-3:]
        grad2 += g * g
        theta = np.clip(theta + rate * g / np.sqrt(grad2), -15, 15)
    weights = {f: float(v) for f, v in zip(names, theta, strict=False) if abs(v) > 1e-3}
    return Field(weights, float(theta[len(names)]), np.array([0.0, *theta[-3:]]))


def fit_scale(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weighted logistic regression by Newton's method, with a small ridge."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-3, 1e-1, 1e-1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge @ w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, taught: DataFrame, per_class: int = PER_CLASS) -> Field | float | None:
    """The field from ``docs`` (doc_id, text) and the labels ``taught`` (doc_id, label 0/1; unique
    ids), of which at most about ``per_class`` of each class are used: few enough to broadcast.
    Of several rows with one id one counts. With one class only, its share of 1 (half a document
    smoothed); None without rows."""
    def learn(table: pa.Table) -> dict | float:
        toxic = table["label"].to_numpy().astype(bool)
        if toxic.all() or not toxic.any():
            return (float(toxic.sum()) + 0.5) / (len(toxic) + 1)
        texts = table["text"].to_pylist()
        bad = np.flatnonzero(toxic)
        keep = sorted([*np.flatnonzero(~toxic),
                       *bad[distinct_texts([texts[i] for i in bad])]])
        model = fit_field([texts[i] for i in keep], toxic[keep])
        x = np.array([summary(p, model, n) for n, _, p in tag(_tokens(texts), model)])
        model.scale = fit_scale(x, toxic.astype(float), table["_weight"].to_numpy())
        return model.state()

    ids = bounded_sample(taught, "label", ["doc_id"], per_class)
    sample = (docs.join(F.broadcast(ids), "doc_id").groupBy("_at", "doc_id", "label", "_weight")
                  .agg(F.min("text").alias("text")))
    state = train(sample, learn)
    return Field(**state) if isinstance(state, dict) else state


def _plain(model):
    return model.state() if isinstance(model, Field) else model


def _slices(column: pa.Array, rows: int = 256) -> Iterator[list[str]]:
    """The texts, some at a time; null counts as empty."""
    for lo in range(0, len(column), rows):
        yield [t or "" for t in column.slice(lo, rows).to_pylist()]


def _model(plain):
    return Field(**plain) if isinstance(plain, dict) else plain


def score(docs: DataFrame, model: Field | float | None) -> DataFrame:
    """``docs`` (doc_id, text, ...): all columns but the text, score, predicted, and spans: start
    and end of the offending tokens (characters of the text) with their marginals."""
    held = docs.sparkSession.sparkContext.broadcast(_plain(model))
    keep = [f for f in docs.schema if f.name not in ("text", "score", "predicted", "spans")]
    at = docs.columns.index("text")
    names = [f.name for f in keep]
    places = [docs.columns.index(c) for c in names]
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())])

    def some(texts: list[str], m) -> Iterator[tuple[float, list[dict]]]:
        for text, (n, marked, p) in zip(texts, tag(_tokens(texts), m), strict=True):
            over = p >= SPAN_CUT
            bad = dict(zip(marked[over].tolist(), p[over].tolist(), strict=True))
            yield document_score(p, m, n), [
                {"start": x.start(), "end": x.end(), "marginal": bad[i]}
                for i, x in enumerate(TOKEN.finditer(text)) if i in bad] if bad else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _model(held.value)
        for b in batches:
            if isinstance(m, Field):
                found = [x for texts in _slices(b.column(at)) for x in some(texts, m)]
            else:
                found = [(m or 0.0, [])] * b.num_rows
            scores = np.array([s for s, _ in found], dtype=np.float64)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k) for k in places], pa.array(scores),
                 pa.array((scores >= PREDICT_CUT).astype(np.int32)),
                 pa.array([x for _, x in found], pa.list_(span))],
                [*names, "score", "predicted", "spans"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep]
                       + ["score double", "predicted int",
                          "spans array<struct<start:int,end:int,marginal:double>>"])
    return docs.mapInArrow(run, schema)


def learn_from(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
               text_col: str = "text", label_col: str = "toxic", mod: int = 4,
               held_out: int = 2, per_class: int = PER_CLASS):
    """The model learned from labels of rows whose crc32 of the id modulo ``mod`` is not
    ``held_out``; null labels teach nothing, of several labels of an id the largest counts."""
    taught = taught_labels(labels, id_col, label_col, mod, held_out)
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return fit(rows, taught, per_class)


def detect(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "toxic", mod: int = 4, held_out: int = 2,
           per_class: int = PER_CLASS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 from score 0.3 on),
    spans.

    Null and empty texts have no tokens; they score what a text without a weighted feature does.
    Without labels every score is 0, with labels of one class their share. Repeated rows are
    scored alike; an empty table gives no rows; texts of any length are read whole; other columns
    are not read.
    """
    model = learn_from(docs, labels, id_col, text_col, label_col, mod, held_out, per_class)
    rows = id_and_text(docs, id_col, text_col).withColumn(
        "held_out", id_remainder("doc_id", mod) == held_out)
    return score(rows, model)


def reject_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns and all other rows stay."""
    model = learn_from(docs, labels, id_col, text_col, **options)
    return keep_clean(docs, model, text_col)


def keep_clean(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that score below the cut, all columns."""
    held = docs.sparkSession.sparkContext.broadcast(_plain(model))
    at = docs.columns.index(text_col)

    def clean(texts: list[str], m: Field) -> list[bool]:
        return [document_score(p, m, n) < PREDICT_CUT for n, _, p in tag(_tokens(texts), m)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _model(held.value)
        for b in batches:
            if isinstance(m, Field):
                stay = [x for texts in _slices(b.column(at)) for x in clean(texts, m)]
            else:
                stay = [(m or 0.0) < PREDICT_CUT] * b.num_rows
            yield b.filter(pa.array(stay, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
