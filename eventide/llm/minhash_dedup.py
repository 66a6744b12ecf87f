"""Near duplicates by MinHash bands, with sequential Bayesian verification.

Sets. ASCII capitals are lower-cased, words are runs of ``[^\\x20\\x09-\\x0D]``; a document's set
holds its distinct shingles of two words (of one word: that word; without words it is empty and
linked with nothing). Documents with equal sets are one node. Two nodes link if
``100 * intersection >= percent * union``.

1. Candidates. A signature has ``rows * bands`` least hashes; nodes that agree on all rows of a
   band share a bucket. Two sets at a similarity of 0.8 meet in none of 40 bands of 5 rows once
   in eight million times.
2. Sequential Bayesian verification. The signatures of a candidate pair are compared in batches.
   After n hashes with m matches (a binomial draw, with a uniform prior of the similarity), the
   posterior probability of a similarity of at least t is P(Binomial(n + 1, t) <= m). A pair is
   pruned as soon as that falls below ``MISS``; what is left is compared on its full sets. Sketches
   go first: one bit of each hash, which agrees at a similarity of s with a chance of (1 + s) / 2,
   under the same bound; they are all that travels for most pairs if those are many.
3. Which pairs are looked at. Only components are wanted, so pairs inside a known component need
   no look. In every bucket each member meets the bucket's leader, its least node. A node first
   takes the leader it shares most buckets with through step 2; then come those of its other
   other leaders that are still in another component. The leaders are done then: in every bucket
   whose other members are of more than one component, members outside its largest component meet
   all members of other components.
4. The pairs of that last step are compared inside the task that holds the bucket, in cells of at
   most ``2 * CELL`` members. What travels to a cell grows as members drop out: sketches first; for
   members that may link with another one of the cell, sketches of ``WIDE`` hashes and the bands,
   as each pair is compared in the first band it shares; for those left, all hashes of their
   shingles. A cell then joins the components that a link connects and looks at no further pair
   between them, so the links that leave the task are fewer than its members; they are verified on
   their full sets as before. Sets of more than ``HELD`` shingles do not travel as hashes: their
   pairs that the sketches cannot rule out all leave.

No pair is dropped but by the two stated chances: not to meet (below 1e-6) and the posterior
bound; that shingles of equal 64-bit hashes make a link which the full sets refute, and which
stood for another one, is rarer by far. Rows grow with the members of buckets, not with their
square; comparisons in step 4 with the members outside the largest component times all members.
Texts move only for nodes of surviving pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import (bounded_broadcast, doc_key, id_and_text, join_split, materialise,
                                 release_shuffles)
from eventide.llm.components import connected_components

PERCENT = 80
#: At a similarity of 0.8 a band meets with a chance of 0.8 ** 5, none of 40 with one of 1.2e-7.
ROWS, BANDS = 5, 40
MISS = 1e-6
#: Hashes compared at a time.
BATCH = 40
#: Hashes of the larger sketch of step 4, members on either side of a cell, and shingles of the
#: largest set whose hashes travel.
WIDE = 1024
CELL = 2048
HELD = 4096
#: Pairs with leaders whose signatures travel at once; of more pairs, sketches travel first.
PAIRS = 500_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_U = np.uint64
_BLOCK = 512


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_LOWER).split()


def shingle_set(text: str) -> set[tuple[bytes, ...]]:
    """The full set of a text."""
    words = words_of(text)
    return set(zip(words, words[1:], strict=False)) if len(words) > 1 else {(w,) for w in words}


def similar(a: set, b: set, percent: int = PERCENT) -> bool:
    both = len(a & b)
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_hashes(text: str) -> np.ndarray:
    """A sorted 64-bit hash for every member of the set. Members are told apart by their words'
    numbers, so the length is the size of the set exactly."""
    words = words_of(text)
    if not words:
        return np.empty(0, dtype=np.uint64)
    distinct = list(set(words))
    number = {w: i for i, w in enumerate(distinct)}
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in distinct], dtype=np.uint64)
    if len(words) == 1:
        return _mix(hashes)
    at = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    pairs = np.unique(at[:-1] * len(distinct) + at[1:])
    first, second = hashes[pairs // len(distinct)], hashes[pairs % len(distinct)]
    return np.sort(_mix(first * _U(0x9E3779B97F4A7C15) + (second ^ (second << _U(21)))))


def _family(k: int) -> tuple[np.ndarray, np.ndarray]:
    """``k`` masks and odd factors of 32 bits."""
    seeds = _mix(np.arange(1, 2 * k + 1, dtype=np.uint64) * _U(0xD6E8FEB86659FD93))
    low = (seeds & _U(0xFFFFFFFF)).astype(np.uint32)
    return low[:k, None], low[k:, None] | np.uint32(1)


def signature(hashes: np.ndarray, family: tuple[np.ndarray, np.ndarray], bits: int = 16) -> bytes:
    """The least hash under each member of the family, ``bits`` (8 or 16) of each kept."""
    masks, factors = family
    x = (hashes >> _U(32)).astype(np.uint32)
    least = np.full(len(masks), 0xFFFFFFFF, dtype=np.uint32)
    for lo in range(0, len(x), _BLOCK):
        np.minimum(least, ((x[None, lo:lo + _BLOCK] ^ masks) * factors).min(axis=1), out=least)
    kept = (least * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)
    return kept.astype(f"<u{bits // 8}").tobytes()


def signatures(rows: DataFrame, keep: list[str], k: int = ROWS * BANDS,
               bits: int = 16) -> DataFrame:
    """``rows`` (text and the columns ``keep``) to ``keep``, n (size of the set), k1, k2 (128 bits
    that name the set; null for an empty set) and sig (``k`` hashes)."""
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = _family(k)
        for batch in batches:
            n, k1, k2, sig = [], [], [], []
            for t in batch.column(len(keep)):
                h = shingle_hashes(t.as_py())
                n.append(len(h))
                name = xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None
                k1.append(name and int.from_bytes(name[:8], "little", signed=True))
                k2.append(name and int.from_bytes(name[8:], "little", signed=True))
                sig.append(signature(h, family, bits) if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(n, pa.int64()), pa.array(k1, pa.int64()),
                 pa.array(k2, pa.int64()), pa.array(sig, pa.binary())],
                [*keep, "n", "k1", "k2", "sig"])

    return rows.select(*keep, "text").mapInArrow(
        run, f"{kinds}, n long, k1 long, k2 long, sig binary")


def sketches(sigs: list[bytes], bits: int = 16) -> pa.Array:
    """The highest bit of each hash of the signatures, as 64-bit words."""
    high = np.frombuffer(b"".join(sigs), f"<u{bits // 8}").reshape(len(sigs), -1) >> (bits - 1)
    words = -(-high.shape[1] // 64)
    flags = np.zeros((len(sigs), 64 * words), dtype=np.uint8)
    flags[:, :high.shape[1]] = high
    flat = np.packbits(flags, axis=1).view(np.int64).ravel()
    ends = np.arange(len(sigs) + 1, dtype=np.int32) * words
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def sketched(signed: DataFrame) -> DataFrame:
    """``signed`` (node, n, sig) with the sketch of the signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, sketches(batch.column(2).to_pylist())],
                    ["node", "n", "sig", "sketch"])

    return signed.select("node", "n", "sig").mapInArrow(
        run, "node long, n long, sig binary, sketch array<long>")


def hashed_sets(rows: DataFrame) -> DataFrame:
    """``rows`` (node, text) to node, n, sketch (of ``WIDE`` hashes) and hashes: those of all
    shingles in order, null beyond ``HELD`` of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = _family(WIDE)
        for batch in batches:
            if not batch.num_rows:
                continue
            sets = [shingle_hashes(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(h) for h in sets], pa.int64()),
                 sketches([signature(h, family, 8) for h in sets], 8),
                 pa.array([h.astype("<u8").tobytes() if len(h) <= HELD else None for h in sets],
                          pa.binary())], ["node", "n", "sketch", "hashes"])

    return rows.select("node", "text").mapInArrow(
        run, "node long, n long, sketch array<long>, hashes binary")


def identify(prints: DataFrame) -> DataFrame:
    """``prints`` with node, a verified 64-bit name of the set (k1, k2): k1, or for the sets that
    share it with another one a new hash of both, until no two sets share a name."""
    named, seed = prints.withColumn("node", F.col("k1")), 0
    while True:
        ends = [f("k1").alias(f"{n}1") for f, n in ((F.min, "lo"), (F.max, "hi"))] + \
               [f("k2").alias(f"{n}2") for f, n in ((F.min, "lo"), (F.max, "hi"))]
        clash = named.where("node is not null").groupBy("node").agg(*ends).where(
            "lo1 <> hi1 or lo2 <> hi2").select("node", F.lit(True).alias("shared"))
        clash = materialise(clash, "minhash-clash")
        if clash.isEmpty():
            return named
        seed += 1
        named = named.join(bounded_broadcast(clash), "node", "left").withColumn(
            "node", F.when(F.col("shared"), F.xxhash64(F.lit(seed), "k1", "k2"))
                     .otherwise(F.col("node"))).drop("shared")


# -- candidates -----------------------------------------------------------------------------

def band_keys(sig: str = "sig") -> Column:
    """The bucket of each band."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(
        F.substr(sig, k * (2 * ROWS) + 1, F.lit(2 * ROWS)), k))


def buckets(signed: DataFrame) -> DataFrame:
    """``signed`` (node, sig) to the members of buckets with several nodes: bucket, node, leader
    (the bucket's least node)."""
    met = signed.select("node", F.explode(band_keys()).alias("bucket"))
    shared = (met.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("hi"))
                 .where("leader < hi").select("bucket", "leader"))
    shared = materialise(shared, "minhash-buckets")
    return materialise(met.join(bounded_broadcast(shared), "bucket").distinct(),
                       "minhash-members")


def star_pairs(members: DataFrame) -> DataFrame:
    """Every member with the leaders it meets: a (leader), b, m (shared buckets)."""
    return members.where("node <> leader").groupBy(
        F.col("leader").alias("a"), F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("m"))


def mixed_buckets(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, besides their leaders, which have met
    every member: bucket, node, root, major (the bucket's largest component), size, most (how many
    are of that component)."""
    rooted = (members.where("node <> leader").select("bucket", "node")
                     .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    mixed = (rooted.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
                   .where("lo < hi").select("bucket"))
    rooted = materialise(rooted.join(mixed, "bucket", "left_semi"), "minhash-mixed")
    sizes = (rooted.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
                   .groupBy("bucket").agg(F.max_by("root", "n").alias("major"),
                                          F.sum("n").alias("size"), F.max("n").alias("most")))
    return join_split(rooted, materialise(sizes, "minhash-sizes"), "bucket")


def dealt_cells(mixed: DataFrame, cell: int = CELL) -> DataFrame:
    """The rows of ``mixed`` by cell: bucket, i, j, chunk, node, root, main (of the largest
    component). A bucket of at most ``cell`` members is one cell. Of a larger one, members of the
    largest component and others are dealt to chunks of their own, and each chunk of others meets
    every chunk in a cell: the largest component is not copied for meeting itself."""
    mains, others = (F.ceil(n / cell).cast("int")
                     for n in (F.col("most"), F.col("size") - F.col("most")))
    small, hashed = F.col("size") <= cell, F.xxhash64("node")
    chunk = (F.when(small, 0).when(F.col("main"), F.pmod(hashed, mains))
              .otherwise(mains + F.pmod(hashed, others)).cast("int"))
    met = F.when(small, F.array(F.lit(0))).otherwise(F.sequence(
        F.when(F.col("main"), mains).otherwise(0), mains + others - 1))
    return (mixed.withColumn("main", F.col("root") == F.col("major"))
                 .withColumn("chunk", chunk).withColumn("other", F.explode(met))
                 .select("bucket", F.least("chunk", "other").alias("i"),
                         F.greatest("chunk", "other").alias("j"), "chunk", "node", "root", "main"))


_DEALT = "bucket long, i int, j int, chunk int, node long, root long, main boolean"


def _by_cell(dealt: DataFrame, more: DataFrame) -> DataFrame:
    columns = [*dealt.columns, *(c for c in more.columns if c != "node")]
    return (dealt.join(more, "node").select(*columns)
                 .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j"))


def cell_candidates(dealt: DataFrame, prints: DataFrame, k: int, percent: int,
                    miss: float) -> DataFrame:
    """The rows of ``dealt`` that the sketches of ``k`` hashes in ``prints`` (node, n, sketch and,
    if known, bands) do not rule out: those which may link with a row of their cell that is of
    another component."""
    most = most_apart(k, percent, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            kept = np.flatnonzero(_may_link(_Cell(rows, most, percent)))
            if len(kept):
                yield from rows.select(range(7)).take(pa.array(kept)).to_batches()

    return materialise(_by_cell(dealt, prints).mapInArrow(run, _DEALT), "minhash-cell-members")


def cell_survivors(dealt: DataFrame, signed: DataFrame, percent: int, miss: float) -> DataFrame:
    """Pairs (a, b) of different components that share a bucket, link by the hashes of ``signed``
    (node, n, sketch, bands, hashes) and join components that no other pair of their cell has
    joined; and those that the sketches do not rule out, if one side has no hashes."""
    most = most_apart(WIDE, percent, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            hashes = [h and np.frombuffer(h, dtype="<u8") for h in rows.column(10).to_pylist()]
            out = _compare_cell(_Cell(rows, most, percent), hashes)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                                 ["a", "b"])

    return _by_cell(dealt, signed.select("node", "n", "sketch", "bands", "hashes")).mapInArrow(
        run, "a long, b long")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows that are equal in the first three columns."""
    held, key = [], None
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True))
        lo = 0
        for hi in range(1, len(keys) + 1):
            if hi < len(keys) and keys[hi] == keys[lo]:
                continue
            if key is not None and keys[lo] != key:
                yield pa.Table.from_batches(held)
                held = []
            key = keys[lo]
            held.append(batch.slice(lo, hi - lo))
            lo = hi
    if held:
        yield pa.Table.from_batches(held)


class _Cell:
    """The rows of a cell as arrays."""

    def __init__(self, rows: pa.Table, most: int, percent: int):
        self.bucket, self.i, self.j = (rows.column(c)[0].as_py() for c in range(3))
        self.chunk, self.node, root, self.main, self.n = (
            rows.column(c).to_numpy() for c in range(3, 8))
        self.root, self.most, self.percent = root.copy(), most, percent
        words = rows.column(8).combine_chunks().flatten().to_numpy()
        self.sketch = words.view(np.uint64).reshape(len(root), -1)
        self.bands = (rows.column(9).combine_chunks().flatten().to_numpy()
                      .reshape(len(root), -1) if rows.num_columns > 9 else None)

    def partners(self, x: int, among: np.ndarray | bool = True) -> np.ndarray:
        """The rows (of ``among``) of other components that x, which is not of the largest one,
        has to meet here, and which sizes and sketches do not rule out."""
        chunk, node, n = self.chunk, self.node, self.n
        # a pair of two such members is looked at once: from the lower chunk, or the lower node
        once = self.main | ((node > node[x]) if self.i == self.j else (chunk > chunk[x]))
        fits = among & once & (self.root != self.root[x])
        fits &= (chunk != chunk[x]) | (self.i == self.j)
        fits &= 100 * np.minimum(n, n[x]) >= self.percent * np.maximum(n, n[x])
        y = np.flatnonzero(fits)
        y = y[np.bitwise_count(self.sketch[y] ^ self.sketch[x]).sum(axis=1) <= self.most]
        if self.bands is None:
            return y
        same = self.bands[y] == self.bands[x]
        # the first band that the pair shares
        return y[self.bands[x][same.argmax(axis=1)] == self.bucket]


def _may_link(cell: _Cell) -> np.ndarray:
    """Which rows of a cell have partners. Two that have one need no look at each other."""
    stays = np.zeros(len(cell.node), dtype=bool)
    for x in np.flatnonzero(~cell.main):
        y = cell.partners(x, ~stays if stays[x] else True)
        stays[y] = True
        stays[x] |= len(y) > 0
    return stays


def _compare_cell(cell: _Cell, hashes: list[np.ndarray | None]) -> list[list[int]]:
    """Members outside the largest component against members of other components."""
    node, n, root, percent = cell.node, cell.n, cell.root, cell.percent
    held = np.array([h is not None for h in hashes])
    out: list[list[int]] = [[], []]

    def emit(x: int, y: np.ndarray) -> None:
        out[0].extend(node[y].tolist())
        out[1].extend([int(node[x])] * len(y))

    for x in np.flatnonzero(~cell.main):
        y = cell.partners(x)
        known = held[y] & held[x]
        emit(x, y[~known])
        y = y[known]
        if not len(y):
            continue
        both = _shared(hashes[x], [hashes[k] for k in y])
        y = y[100 * both >= percent * (n[y] + n[x] - both)]
        y = y[np.unique(root[y], return_index=True)[1]]  # one link to a component is enough
        emit(x, y)
        root[np.isin(root, root[y])] = root[x]
    return out


def _shared(one: np.ndarray, others: list[np.ndarray], at_once: int = 1 << 20) -> np.ndarray:
    """How many hashes of each of ``others`` (sorted, not empty) are in ``one``."""
    counts, lo = [], 0
    while lo < len(others):
        hi, size = lo, 0
        while hi < len(others) and (hi == lo or size + len(others[hi]) <= at_once):
            size += len(others[hi])
            hi += 1
        part = others[lo:hi]
        flat = np.concatenate(part)
        found = one[np.minimum(np.searchsorted(one, flat), len(one) - 1)] == flat
        starts = np.cumsum([0, *map(len, part[:-1])])
        counts.append(np.add.reduceat(found.astype(np.int64), starts))
        lo = hi
    return np.concatenate(counts)


# -- verification ---------------------------------------------------------------------------

def least_matches(n: int, t: float, miss: float) -> int:
    """The fewest matches among n hashes with a posterior of at least ``miss`` for a similarity
    of t or more, under a uniform prior: the least m with P(Binomial(n + 1, t) <= m) >= miss."""
    total, whole = 0.0, math.lgamma(n + 2)
    for m in range(n + 1):
        total += math.exp(whole - math.lgamma(m + 1) - math.lgamma(n + 2 - m)
                          + m * math.log(t) + (n + 1 - m) * math.log(1 - t))
        if total >= miss:
            return m
    return n


def _needs(k: int, batch: int, percent: int, miss: float) -> list[tuple[int, int]]:
    """Where each batch of ``k`` hashes ends, and the fewest matches up to there."""
    ends = [min(e, k) for e in range(batch, k + batch, batch)]
    return [(e, least_matches(e, percent / 100, miss)) for e in ends]


def most_apart(k: int, percent: int, miss: float) -> int:
    """How many of the ``k`` bits of two sketches may differ. At a similarity of s a bit agrees
    with a chance of (1 + s) / 2: the least hashes are the same, or their bits are by chance."""
    return k - least_matches(k, (1 + percent / 100) / 2, miss)


def promising(pairs: DataFrame, signed: DataFrame, percent: int, miss: float) -> DataFrame:
    """The pairs (a, b) that neither the sizes of the sets nor their sketches rule out."""
    def side(name: str) -> DataFrame:
        return signed.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"),
                             F.col("sketch").alias(f"sketch_{name}"))

    size_fits = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    apart = F.aggregate(F.zip_with("sketch_a", "sketch_b",
                                   lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                        F.lit(0), lambda total, bits: total + bits)
    both = join_split(pairs, side("a"), "a").join(side("b"), "b")
    return materialise(both.where(size_fits & (apart <= most_apart(ROWS * BANDS, percent, miss)))
                           .select("a", "b"), "minhash-promising")


def survivors(pairs: DataFrame, signed: DataFrame, percent: int, miss: float) -> DataFrame:
    """The pairs (a, b) that the signatures do not rule out. Sets whose sizes alone keep them
    below the threshold go first, and of more than ``PAIRS`` pairs those that sketches rule out."""
    k = ROWS * BANDS
    need = _needs(k, BATCH, percent, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u2")
                    .reshape(-1, k) for c in (2, 3))
            alive, seen = np.arange(batch.num_rows), 0
            matches = np.zeros(batch.num_rows, dtype=np.int64)
            for end, least in need:
                matches[alive] += (x[alive, seen:end] == y[alive, seen:end]).sum(axis=1)
                alive, seen = alive[matches[alive] >= least], end
            rows = pa.array(alive)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows)], ["a", "b"])

    def side(name: str) -> DataFrame:
        return signed.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"),
                             F.col("sig").alias(f"sig_{name}"))

    if pairs.limit(PAIRS + 1).count() > PAIRS:
        pairs = promising(pairs, signed, percent, miss)
    size_fits = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    both = join_split(pairs, side("a"), "a").join(side("b"), "b").where(size_fits)
    return materialise(both.select("a", "b", "sig_a", "sig_b")
                           .mapInArrow(run, "a long, b long"), "minhash-survivors")


def exact_links(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, set()
        for batch in batches:
            kept = []
            for i, (a, x, y) in enumerate(zip(*(batch.column(c) for c in (0, 2, 3)),
                                              strict=True)):
                if last is None or a.as_py() != last:
                    last, held = a.as_py(), shingle_set(x.as_py())
                if similar(held, shingle_set(y.as_py()), percent):
                    kept.append(i)
            rows = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows)], ["a", "b"])

    def side(name: str) -> DataFrame:
        return texts.select(F.col("node").alias(name), F.col("text").alias(f"text_{name}"))

    both = join_split(join_split(pairs, side("b"), "b"), side("a"), "a", counted=pairs)
    return materialise(both.select("a", "b", "text_a", "text_b").mapInArrow(
        run, "a long, b long"), "minhash-links")


def _texts(rows: DataFrame, prints: DataFrame, nodes: DataFrame) -> DataFrame:
    """One text for each of ``nodes`` (node): node, text."""
    names = (prints.join(bounded_broadcast(materialise(nodes, "minhash-nodes")), "node",
                         "left_semi")
                   .groupBy("node").agg(F.min("name").alias("name")))
    names = materialise(names, "minhash-names")
    named = rows.join(bounded_broadcast(names), "name").select("node", "text")
    twice = prints.join(names, ["node", "name"], "left_semi").groupBy("name").count().where(
        "count > 1")
    # rows that repeat id and text share a name
    return named if twice.isEmpty() else named.dropDuplicates(["node"])


def _both_ends(pairs: DataFrame) -> DataFrame:
    # each end reduced by itself: pairs are many more than nodes
    ends = [pairs.select(F.col(end).alias("node")).distinct() for end in ("a", "b")]
    return ends[0].union(ends[1]).distinct()


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components."""
    def side(name: str) -> DataFrame:
        return roots.select(F.col("node").alias(name), F.col("root").alias(f"r_{name}"))

    return (join_split(pairs, side("a"), "a", "left").join(side("b"), "b", "left")
            .where(F.coalesce("r_a", "a") != F.coalesce("r_b", "b")).select("a", "b", "m"))


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components of known components and further links."""
    known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return connected_components(known.union(links))


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          percent: int = PERCENT, miss: float = MISS,
                          cell: int = CELL) -> DataFrame:
    """One row per input row: doc_id, n_shingles (size of the set), component_id (smallest doc_id
    reachable over links, its own included) and kept (doc_id = component_id).

    Null texts, empty texts and texts without words have an empty set and are linked with
    nothing: each is its own component. Repeated rows have equal sets and one component, and are
    kept alike; a null id is the smallest only if all ids of the component are null; an empty
    table gives no rows; texts of any length are read whole; other columns are not read.
    """
    rows = id_and_text(docs, id_col, text_col).select(doc_key().alias("name"), "doc_id", "text")
    prints = identify(materialise(signatures(rows, ["name", "doc_id"]), "minhash"))
    filled = prints.where("node is not null")
    members = buckets(filled.select("node", "sig"))
    nodes = materialise(members.select("node").distinct(), "minhash-nodes")
    known = filled.join(bounded_broadcast(nodes), "node", "left_semi").select("node", "n", "sig")
    known = materialise(sketched(known.dropDuplicates(["node"])), "minhash-candidates")
    release_shuffles(docs.sparkSession)
    roots = docs.sparkSession.createDataFrame([], "node long, root long")

    def verified(found: DataFrame, roots: DataFrame) -> DataFrame:
        release_shuffles(docs.sparkSession)
        if found.isEmpty():
            return roots
        texts = materialise(_texts(rows, filled, _both_ends(found)), "minhash-texts")
        links = exact_links(found.select("a", "b"), texts, percent)
        release_shuffles(docs.sparkSession)
        roots = _joined(roots, links)
        release_shuffles(docs.sparkSession)
        return roots

    pairs = materialise(star_pairs(members), "minhash-pairs")
    best = _most_promising(pairs)
    roots = verified(survivors(best, known, percent, miss), roots)
    rest = materialise(_apart(pairs.join(best, ["a", "b"], "left_anti"), roots), "minhash-rest")
    roots = verified(survivors(rest.select("a", "b"), known, percent, miss), roots)

    mixed = materialise(mixed_buckets(members, roots), "minhash-mixed-sizes")
    release_shuffles(docs.sparkSession)
    dealt = cell_candidates(dealt_cells(mixed, cell), known.select("node", "n", "sketch"),
                            ROWS * BANDS, percent, miss)
    release_shuffles(docs.sparkSession)
    if not dealt.isEmpty():
        inside = materialise(dealt.select("node").distinct(), "minhash-inside")
        wide = (hashed_sets(_texts(rows, filled, inside))
                .join(known.select("node", band_keys().alias("bands")), "node")
                .select("node", "n", "sketch", "bands", "hashes"))
        wide = materialise(wide, "minhash-wide")
        release_shuffles(docs.sparkSession)
        dealt = cell_candidates(dealt, wide.drop("hashes"), WIDE, percent, miss)
        release_shuffles(docs.sparkSession)
        pairs = materialise(cell_survivors(dealt, wide, percent, miss), "minhash-cells")
        roots = verified(pairs, roots)
    return _components(prints, roots)


def _most_promising(pairs: DataFrame) -> DataFrame:
    """Of the pairs (a, b, m) of each b, the one with the largest m."""
    best = pairs.groupBy("b").agg(F.max_by("a", F.struct("m", F.col("a"))).alias("a"))
    return materialise(best.select("a", "b"), "minhash-best")


def _components(prints: DataFrame, roots: DataFrame) -> DataFrame:
    """Every row with the smallest id of its component. Only sets with several rows or links
    are joined back; any other row is its own component."""
    sets = prints.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    labelled = sets.join(roots, "node", "left").where("rows > 1 or root is not null").select(
        "node", F.coalesce("root", "node").alias("root"), "least")
    labelled = materialise(labelled, "minhash-labelled")
    whole = labelled.groupBy("root").agg(F.min("least").alias("least"))
    classes = materialise(labelled.select("node", "root").join(whole, "root")
                                  .select("node", "least"), "minhash-classes")
    own: Column = F.coalesce("least", "doc_id")
    return (prints.join(bounded_broadcast(classes), "node", "left")
                  .select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"),
                          F.col("doc_id").eqNullSafe(own).alias("kept")))
