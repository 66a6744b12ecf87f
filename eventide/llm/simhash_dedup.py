"""Near duplicates by SimHash, linked through the generalised pigeonhole principle.

Fingerprints. ASCII capitals are lower-cased, words are runs of ``[^\\x20\\x09-\\x0D]``, shingles
are three words joined by spaces, repeats included (fewer words: the whole sequence). A bit is 1
if it is set in more than half of the shingles' XXH64 (seed 42). A text without words has
fingerprint 0.

Links. Two fingerprints link at ``radius`` (2) or fewer differing bits. The 64 bits are grouped
into partitions, correlated bits together. With thresholds T_i >= -1 that add up to
radius - partitions + 1, two linked fingerprints differ in at most T_i bits of some partition i;
a partition with T_i = -1 need not be looked at. Partition counts and thresholds come from a
dynamic program over estimated costs: probe rows plus candidates, both taken from the data. A
probe enumerates the values within T_i bits of its own, meets the fingerprints that have such a
value, and the full distance is verified in the join.

Buckets of more than ``BUCKET`` fingerprints, where pairs would grow with the square, take an
exact way without pairs: two fingerprints within 2 bits have a common midpoint within 1 bit of
each, and at most 65 different fingerprints lie within 1 bit of a midpoint. Every member sends
itself to its 65 midpoints and each midpoint links its members to the smallest one.

Copies share a fingerprint, so links run between distinct fingerprints and copies only join their
class. Groups are the connected components of the links.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import bounded_broadcast, doc_key, free_name, id_and_text, materialise
from eventide.llm.components import connected_components

SHINGLE = 3
RADIUS = 2
BITS = 64
#: Beyond this many fingerprints in a bucket, midpoints cost less than pairs: comparing two
#: fingerprints inside the join takes about a tenth of the time of shuffling and grouping a row,
#: and a fingerprint has 65 midpoints.
BUCKET = 512
#: Partition counts the planner weighs against each other.
PARTITIONS = (1, 2, 3, 4, 6)

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLOCK = 1 << 15


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text, as a signed number."""
    words = text.encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    digest, width = xxhash.xxh64_intdigest, min(shingle, len(words))
    ones = np.zeros(BITS, dtype=np.int64)
    for lo in range(0, n, _BLOCK):
        hi = min(n, lo + _BLOCK)
        h = np.array([digest(line[s:e - 1], 42) for s, e in
                      zip(starts[lo:hi], ends[lo + width - 1:hi + width - 1], strict=True)],
                     dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits((ones * 2 > n).astype(np.uint8), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """One row per input row: doc_id, fp (signed 64 bits). A null text counts as empty."""
    rows = id_and_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())],
                                             ["doc_id", "fp"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, fp long")


# -- the plan: which bits go together, and how many of them may differ ------------------------

@dataclass(frozen=True)
class Part:
    bits: tuple[int, ...]
    threshold: int

    @property
    def mask(self) -> int:
        return _signed(sum(1 << b for b in self.bits))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how often each two bits are set together (64 x 64), summed
    over all of them: each task adds up its own matrix, one row per bit leaves it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS))
        for b in batches:
            x = b.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            for lo in range(0, len(x), _BLOCK):
                m = np.unpackbits(x[lo:lo + _BLOCK].copy().view(np.uint8).reshape(-1, 8), axis=1,
                                  bitorder="little").astype(np.float64)
                m = np.hstack([m, np.ones((len(m), 1))])
                both += (m.T @ m)[:BITS, :BITS]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(BITS), BITS).astype(np.int32)),
             pa.array(np.tile(np.arange(BITS), BITS).astype(np.int32)),
             pa.array(both.ravel())], ["i", "j", "n"])

    total = fps.count()
    out = np.zeros((BITS, BITS))
    for r in (fps.select("fp").mapInArrow(run, "i int, j int, n double")
                 .groupBy("i", "j").agg(F.sum("n").alias("n")).collect()):
        out[r.i, r.j] = r.n
    return total, out


def group_bits(total: int, both: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """``parts`` groups of nearly equal size: each starts at the free bit that is most
    correlated with the others and takes the free bit most correlated with the group."""
    p = np.diag(both) / max(total, 1)
    cov = both / max(total, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, out = list(range(BITS)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        group = [max(free, key=lambda b: (corr[b, free].sum(), -b))]
        free.remove(group[0])
        while len(group) < size:
            b = max(free, key=lambda b: (corr[b, group].sum(), -b))
            group.append(b)
            free.remove(b)
        out.append(tuple(sorted(group)))
    return out


def same_value_pairs(fps: DataFrame, groups: Sequence[tuple[int, ...]]) -> list[float]:
    """For each group of bits: how many pairs of fingerprints agree on all of them."""
    keyed = fps.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), _value("fp", g).alias("v"))
        for i, g in enumerate(groups)])).alias("k")).select("k.*")
    rows = (keyed.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
                 .groupBy("i").agg(F.sum(F.col("n").cast("double") * (F.col("n") - 1) / 2)
                                    .alias("pairs")).collect())
    found = {r.i: r.pairs for r in rows}
    return [found.get(i, 0.0) for i in range(len(groups))]


def allocate(costs: Sequence[Sequence[float]], radius: int) -> tuple[float, tuple[int, ...]]:
    """Thresholds -1..radius, one per partition, that add up to radius - partitions + 1 at the
    least total cost; ``costs[i][t]`` is partition i's cost at threshold t (-1 costs nothing).
    A dynamic program over partitions and the sum so far."""
    best: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for cost in costs:
        step: dict[int, tuple[float, tuple[int, ...]]] = {}
        for s, (c, chosen) in best.items():
            for t in range(-1, radius + 1):
                new = (c + (cost[t] if t >= 0 else 0.0), (*chosen, t))
                if s + t not in step or new < step[s + t]:
                    step[s + t] = new
        best = step
    return best[radius - len(costs) + 1]


def plan(fps: DataFrame, radius: int = RADIUS,
         partitions: Sequence[int] = PARTITIONS) -> list[Part]:
    """The cheapest partitions and thresholds for these fingerprints. Candidates at threshold 0
    are counted; each further bit multiplies them by the odds that two fingerprints differ in a
    bit, summed over the partition's bits."""
    total, both = bit_statistics(fps)
    p = np.diag(both) / max(total, 1)
    same = np.clip(p * p + (1 - p) * (1 - p), 0.5, 1 - 1e-9)
    odds = (1 - same) / same
    layouts = [group_bits(total, both, m) for m in partitions if m <= radius + 2]
    flat = [g for layout in layouts for g in layout]
    pairs = dict(zip(flat, same_value_pairs(fps, flat), strict=True))
    best = None
    for layout in layouts:
        costs = []
        for g in layout:
            near = total * total / 2.0 * float(np.prod(same[list(g)]))
            at0 = max(pairs[g], near)
            sums = [1.0] + [0.0] * radius  # elementary symmetric sums of the odds
            for b in g:
                for k in range(radius, 0, -1):
                    sums[k] += sums[k - 1] * odds[b]
            rows = list(itertools.accumulate(math.comb(len(g), k) for k in range(radius + 1)))
            costs.append([total * (1 + rows[t]) + at0 * sum(sums[:t + 1])
                          for t in range(radius + 1)])
        found = (*allocate(costs, radius), len(layout), layout)
        best = found if best is None or found[0] < best[0] else best
    _, thresholds, _, layout = best
    return [Part(g, t) for g, t in zip(layout, thresholds, strict=True) if t >= 0]


# -- links --------------------------------------------------------------------------------

def _value(fp: str, bits: Sequence[int]) -> Column:
    return F.col(fp).bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))))


def _flips(bits: Sequence[int], most: int) -> list[int]:
    return [_signed(sum(1 << b for b in c))
            for k in range(most + 1) for c in itertools.combinations(bits, k)]


def _xor_all(v: Column, flips: Sequence[int]) -> Column:
    """The value under every flip."""
    many = F.array(*map(F.lit, flips)).cast("array<bigint>")
    return F.transform(many, lambda x: v.bitwiseXOR(x))


def star_links(fps: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that connect whatever lies within ``radius``, without forming pairs. For an
    even radius 2k each fingerprint goes to all values within k bits of it; for an odd one, the
    same with one bit left out, in turn. Those that meet are within the radius of each other and
    are linked to the smallest."""
    half = radius // 2
    if radius % 2 == 0:
        keys = F.transform(_xor_all(F.col("fp"), _flips(range(BITS), half)),
                           lambda z: F.struct(F.lit(-1).alias("out"), z.alias("z")))
    else:
        def without(b: int) -> Column:
            rest = [x for x in range(BITS) if x != b]
            return F.transform(_xor_all(_value("fp", rest), _flips(rest, half)),
                               lambda z: F.struct(F.lit(b).alias("out"), z.alias("z")))

        keys = F.flatten(F.array(*[without(b) for b in range(BITS)]))
    met = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.out", "k.z")
    least = met.groupBy("out", "z").agg(F.min("fp").alias("a"), F.max("fp").alias("last"))
    return (met.join(least.where("a < last").drop("last"), ["out", "z"])
               .where("fp <> a").select("a", F.col("fp").alias("b")).distinct())


def links(fps: DataFrame, parts: Sequence[Part], radius: int = RADIUS,
          bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fps`` (fp): all pairs within ``radius`` that
    meet in a bucket of at most ``bucket`` members, and for larger buckets links that connect
    the same fingerprints."""
    index = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), _value("fp", p.bits).alias("v"))
        for i, p in enumerate(parts)])).alias("k")).select("fp", "k.i", "k.v")
    sizes = index.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    large = materialise(sizes.where(F.col("n") > bucket).select("i", "v"), "large-buckets")
    small = index.join(large, ["i", "v"], "left_anti")

    def probe(i: int, p: Part) -> Column:
        return F.transform(_xor_all(_value("fp", p.bits), _flips(p.bits, p.threshold)),
                           lambda v: F.struct(F.lit(i).alias("i"), v.alias("v")))

    # members of large buckets probe as well: a threshold above 0 leads out of their bucket
    probes = fps.select("fp", F.explode(F.concat(*[
        probe(i, p) for i, p in enumerate(parts)])).alias("k")).select(
            F.col("fp").alias("a"), "k.i", "k.v")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("fp"))) <= radius
    direct = (probes.join(small, (probes.i == small.i) & (probes.v == small.v)
                          & (F.col("a") != F.col("fp")) & near)
                    .select("a", F.col("fp").alias("b")))
    crowded = index.join(large, ["i", "v"], "left_semi").select("fp").distinct()
    return direct.union(star_links(crowded, radius))


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per input row: doc_id, fp, fingerprint (16 hex digits), component_id (smallest
    doc_id reachable over links, its own included) and component_size (rows).

    Null and empty texts and texts without words have fingerprint 0, which links like any other.
    Repeated rows share a fingerprint and a component; a null id is never the smallest unless
    all ids of the component are null; an empty table gives no rows; texts of any length are
    read whole; other columns are not read.
    """
    prints = materialise(fingerprints(docs, id_col, text_col, shingle), "simhash")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("rep"),
                                     F.count(F.lit(1)).alias("rows"))
    nodes = materialise(nodes, "simhash-nodes")
    fps = nodes.select("fp")
    parts = plan(fps, radius)
    roots = connected_components(links(fps, parts, radius))
    labelled = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    whole = labelled.groupBy("root").agg(F.min("rep").alias("component_id"),
                                         F.sum("rows").alias("component_size"))
    classes = labelled.join(whole, "root").select("fp", "component_id", "component_size")
    return prints.join(classes, "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id", "component_size")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component, all columns: the smallest id (from 0 on; null
    last), then the smallest text hash; of rows that repeat id and text any one. Only names of
    dropped rows are joined back; texts are not shuffled while those are few enough to
    broadcast."""
    key = free_name(docs, "_key")
    named = docs.withColumn(key, doc_key(id_col, text_col))
    groups = materialise(near_duplicate_groups(named, key, text_col, shingle, radius)
                         .select(F.col("doc_id").alias(key), "component_id"), "components")
    drop = materialise(groups.where(F.col(key) != F.col("component_id")).select(key).distinct(),
                       "dropped-copies")
    left = named.join(bounded_broadcast(drop), key, "left_anti")
    twice = materialise(groups.where(F.col(key) == F.col("component_id")).groupBy(key).count()
                        .where("count > 1").select(key), "repeated-rows")
    if not twice.isEmpty():
        some = bounded_broadcast(twice)
        left = left.join(some, key, "left_anti").unionByName(
            left.join(some, key, "left_semi").dropDuplicates([key]))
    return left.select(docs.columns)
