"""Benchmark decontamination: SimHash of item-sized windows, a multi-index Hamming lookup, and
exact weighted-shingle similarity.

Words are runs of letters, digits and marks, lower-cased; shingles are five words (an item of
fewer words is one shingle of all its words). A document is contaminated by an item if a window
of as many words as the item has (the whole document if it is shorter) has similarity of at least
``SIMILARITY`` to it: the sum over shingles of the smaller count over the sum of the larger.

1. Windows. A window of n words can only reach the threshold if enough of its places hold a
   shingle of some item of n words, in whatever order, so a window is laid at every start with
   that many (``_with_starts``). Whose shingles they were is forgotten; only document, start and size
   go on.
2. Fingerprints. A bit is 1 if it is set in more than half of the window's shingle hashes. The 64
   bit counts of a window are summed in 16 packed words of four counters.
3. Lookup. Item fingerprints are indexed in ``BLOCKS`` blocks, under every value within
   ``RADIUS // BLOCKS`` bits of the block's own. If two fingerprints differ in at most ``RADIUS``
   bits, some block differs in at most that many, so no item within the radius is missed.
4. Verification on the words themselves.

The benchmark is a query set: its shingles are broadcast in blocks of at most ``BROADCAST_ROWS``
rows, so the documents are scanned and never shuffled to find where a window may lie. All steps
are DataFrame functions.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import (BROADCAST_ROWS, bounded_broadcast, doc_key, free_name,
                                 id_and_text, materialise)

SHINGLE = 5
SIMILARITY = 0.8
#: Fingerprints of texts with similarity 0.8 differ in 10 bits on average; 23 is 4.6 deviations
#: above that.
RADIUS = 23
BLOCKS = 8


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}\p{M}]+"), F.lit(0))


def _shingle_count(n: Column, width: int) -> Column:
    return F.greatest(n - (width - 1), F.lit(0))


def _windows_of(words: str, width: int) -> Column:
    """Start positions 0.. of the shingles of ``width`` words."""
    n = _shingle_count(F.size(words), width)
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(
        F.array().cast("array<int>"))


def shingle_hashes(words: str, width: int) -> Column:
    return F.transform(_windows_of(words, width), lambda i: F.xxhash64(
        *[F.get(F.col(words), i + k) for k in range(width)]))


def shingle_texts(words: str, width: Column) -> Column:
    """The shingles themselves, joined by spaces (a word holds none)."""
    n = F.greatest(F.size(words) - width + 1, F.lit(0))
    at = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.array_join(F.slice(F.col(words), i, width), " "))


#: A packed counter has 16 bits, the topmost a sign.
RUN = 32_767


def simhash(hashes: str | Column) -> Column:
    """64 majority bits of an array of 64-bit hashes; empty: 0. Packed word k counts bits k,
    k + 16, k + 32 and k + 48 side by side; of a longer array than ``RUN`` the words of each run
    are unpacked and added. Hashes and packed words are lambda variables, so neither is made again
    for every bit that is read from it."""
    one = F.lit(0x0001000100010001)
    zero = F.lit(0).cast("long")

    def packed(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: F.aggregate(
            h, zero, lambda acc, x: acc + F.call_function(
                "shiftrightunsigned", x, k).bitwiseAND(one)))

    def counter(words: Column, bit: int) -> Column:
        return F.shiftrightunsigned(F.get(words, F.lit(bit % 16)), 16 * (bit // 16)) \
                .bitwiseAND(F.lit(0xFFFF))

    def majority(counts: Callable[[int], Column], n: Column) -> Column:
        fp = zero
        for bit in range(64):
            value = (1 << bit) - (1 << 64 if bit == 63 else 0)
            fp = fp.bitwiseOR(F.when(counts(bit) * 2 > n, F.lit(value).cast("long"))
                              .otherwise(zero))
        return fp

    def of_runs(h: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(h), F.lit(1)), F.lit(RUN))
        runs = F.transform(starts, lambda at: packed(F.slice(h, at, RUN)))
        added = F.aggregate(
            runs, F.array_repeat(zero, 64), lambda acc, words: F.zip_with(
                acc, F.array(*[counter(words, b) for b in range(64)]), lambda x, y: x + y))
        return F.transform(F.array(F.struct(added.alias("c"), F.size(h).alias("n"))),
                           lambda p: majority(lambda b: F.get(p.c, F.lit(b)), p.n))

    def of_one(h: Column) -> Column:
        return F.transform(F.array(F.struct(packed(h).alias("c"), F.size(h).alias("n"))),
                           lambda p: majority(lambda b: counter(p.c, b), p.n))

    hs = F.col(hashes) if isinstance(hashes, str) else hashes
    return F.element_at(F.when(F.size(hs) <= RUN, of_one(hs)).otherwise(of_runs(hs)), 1)


def simhash_of_words(words: str, width: int) -> Column:
    """SimHash of the shingles of an array of words; fewer words than a shingle give 0."""
    return simhash(shingle_hashes(words, width))


def _block(fp: str, k: int) -> Column:
    width = 64 // BLOCKS
    return F.shiftrightunsigned(fp, width * k).bitwiseAND(F.lit((1 << width) - 1))


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Texts of items with words, each once: item (its number; materialise it), item_id, words, n
    (their number), width (of a shingle)."""
    return (id_and_text(benchmark, item_col, text_col)
            .select(F.col("doc_id").alias("item_id"), words_of(F.col("text")).alias("words"))
            .distinct()
            .withColumn("n", F.size("words")).where("n > 0")
            .withColumn("width", F.least(F.lit(SHINGLE), F.col("n")))
            .withColumn("item", F.monotonically_increasing_id()))


def multi_index(items: DataFrame, radius: int = RADIUS, key: str = "item_id") -> DataFrame:
    """(n, block, value) under which a row (``key``, fp, n) is found: every value of a block
    within ``radius // BLOCKS`` bits of the item's."""
    width = 64 // BLOCKS
    flips = [sum(1 << b for b in c) for r in range(radius // BLOCKS + 1)
             for c in itertools.combinations(range(width), r)]

    def entry(k: int) -> Column:
        values = F.transform(F.array(*map(F.lit, flips)),
                             lambda x: _block("fp", k).bitwiseXOR(x.cast("long")))
        return F.struct(F.lit(k).alias("block"), values.alias("values"))

    entries = F.array(*[entry(k) for k in range(BLOCKS)])
    return (items.select(key, "n", "fp", F.explode(entries).alias("e"))
                 .select(key, "n", F.col("fp").alias("item_fp"), "e.block",
                         F.explode("e.values").alias("value")))


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
            text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
            threshold: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """One row per document and item that contaminates it: doc_key, doc_id, item_id, similarity
    (the best window's), distance (of fingerprints), start and words (the best window, the first
    of equals; words counted from 0), windows (how many reach the threshold).

    Null texts count as empty; documents and items without words match nothing; repeated rows
    (same id and text) share one set of rows; a null id is a document, or an item, like any other;
    benchmark rows with one item_id are texts of one item, each looked for by itself; an empty
    table gives no rows; texts of any length are read whole; other columns are not read.
    """
    rows = id_and_text(docs, id_col, text_col).select(
        doc_key().alias("doc_key"), "doc_id", "text")
    items = materialise(_items(benchmark, item_col, item_text), "benchmark-items")
    out = [_matches_of_width(rows, items.where(F.col("width") == w), w, threshold, radius)
           for w in sorted(r[0] for r in items.select("width").distinct().collect())]
    if not out:
        out = [_matches_of_width(rows, items, SHINGLE, threshold, radius)]
    return _best(reduce(DataFrame.union, out))


def _anchors(rows: DataFrame, shingles: DataFrame, width: int) -> DataFrame:
    """Where shingles of the benchmark stand: doc_key, n_words, pos, h. ``shingles`` (h, ...) is
    taken in blocks that are small enough to broadcast."""
    known = materialise(shingles.select("h").distinct(), "benchmark-shingles")
    blocks = max(1, -(-known.count() // BROADCAST_ROWS))
    found = []
    for b in range(blocks):
        part = known.where(F.pmod("h", F.lit(2 * blocks)).isin(2 * b, 2 * b + 1))
        # The words stay behind: an exploded row carries three numbers and the key. (The outer
        # form, as the optimizer would test the inner one's array for emptiness by making it
        # once more, word by word.)
        hashed = (rows.select("doc_key", words_of(F.col("text")).alias("words"))
                      .select("doc_key", F.size("words").alias("n_words"),
                              shingle_hashes("words", width).alias("hs")))
        found.append(hashed.select("doc_key", "n_words",
                                   F.posexplode_outer("hs").alias("pos", "h"))
                           .where("pos is not null")
                           .join(F.broadcast(part), "h", "left_semi"))
    return materialise(reduce(DataFrame.union, found), "benchmark-anchors")


def _with_starts(at: DataFrame, threshold: float, width: int) -> DataFrame:
    """``at`` (doc_key, n_words, n, places: the sorted positions of shingles of items of n words)
    with starts: every start whose window could reach the threshold. Of a and b shingles, c in
    common are a similarity of c / (a + b - c), so c is at least threshold * (a + b) /
    (1 + threshold), and the window has no fewer places. A start is found from the first place at
    or after it; a document shorter than the item is one window."""
    both = (F.col("n") - width + 1) + (F.col("span") + 1)
    # what rounding puts on the border is let in
    need = F.ceil(both * (threshold / (1 + threshold)) - 1e-6).cast("int")

    def own(p: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get("places", i - 1)).otherwise(F.lit(-1))
        reach = F.get("places", i + F.col("need") - 1)
        low = F.greatest(before + 1, reach - F.col("span"))
        high = F.least(p, F.col("last"))
        return F.when(reach.isNotNull() & (low <= high), F.sequence(low, high)).otherwise(
            F.array().cast("array<int>"))

    return (at.withColumn("span", F.least("n", "n_words") - width)
              .withColumn("last", F.greatest(F.col("n_words") - F.col("n"), F.lit(0)))
              .withColumn("need", F.greatest(need, F.lit(1)))
              .withColumn("starts", F.flatten(F.transform("places", own))))


def _matches_of_width(rows: DataFrame, items: DataFrame, width: int, threshold: float,
                      radius: int) -> DataFrame:
    hashed = items.withColumn("hashes", shingle_hashes("words", width))
    known = hashed.select("n", F.explode("hashes").alias("h")).distinct()
    laid = (_anchors(rows, known, width).join(bounded_broadcast(known), "h")
            .groupBy("doc_key", "n_words", "n")
            .agg(F.array_sort(F.collect_set("pos")).alias("places")))
    laid = (_with_starts(laid, threshold, width).where(F.size("starts") > 0)
            .groupBy("doc_key").agg(F.collect_list(F.struct("n", "starts")).alias("at")))
    laid = materialise(laid, "benchmark-windows")
    cut = F.slice("words", F.col("start") + 1, F.col("w.n"))
    windows = (rows.join(bounded_broadcast(laid), "doc_key")
                   .select("doc_key", "doc_id", words_of(F.col("text")).alias("words"), "at")
                   .select("doc_key", "doc_id", "words", F.explode("at").alias("w"))
                   .select("doc_key", "doc_id", "words", "w", F.explode("w.starts").alias("start"))
                   .select("doc_key", "doc_id", "start", "w.n", cut.alias("words"))
                   .dropDuplicates(["doc_key", "start", "n"])
                   .withColumn("fp", simhash_of_words("words", width)))
    index = multi_index(hashed.withColumn("fp", simhash("hashes")), radius, "item")
    blocks = F.array(*[F.struct(F.lit(k).alias("block"), _block("fp", k).alias("value"))
                       for k in range(BLOCKS)])
    near = (windows.withColumn("e", F.explode(blocks))
                   .select("doc_key", "doc_id", "start", "n", "words", "fp", "e.block", "e.value")
                   .join(bounded_broadcast(index), ["n", "block", "value"]))
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    # each pair once: in the first block in which it meets
    first = F.array_min(F.array(*[
        F.when(F.bit_count(_block("fp", k).bitwiseXOR(_block("item_fp", k)))
               <= radius // BLOCKS, F.lit(k)) for k in range(BLOCKS)]))
    candidates = near.where((distance <= radius) & (F.col("block") == first)).select(
        "doc_key", "doc_id", "start", "n", "words", "item", distance.alias("distance"))
    texts_of = items.select("item", "item_id", F.col("words").alias("item_words"))
    scored = candidates.join(texts_of, "item").withColumn(
        "similarity", weighted_similarity("words", "item_words", width))
    best = F.struct((-F.col("similarity")).alias("s"), "start", F.size("words").alias("words"),
                    "distance")
    return (scored.where(F.col("similarity") >= threshold)
                  .select("doc_key", "doc_id", "item_id", "start", "n", best.alias("b")))


def _best(scored: DataFrame) -> DataFrame:
    """The best window of each document and item, and how many windows there are (one that
    reaches several texts of an item counts once)."""
    return (scored.groupBy("doc_key", "doc_id", "item_id", "start", "n")
                  .agg(F.min("b").alias("b"))
                  .groupBy("doc_key", "doc_id", "item_id")
                  .agg(F.min("b").alias("b"), F.count(F.lit(1)).alias("windows"))
                  .select("doc_key", "doc_id", "item_id", (-F.col("b.s")).alias("similarity"),
                          "b.distance", "b.start", "b.words", "windows"))


def weighted_similarity(a: str, b: str, width: int) -> Column:
    """Sum of the smaller over sum of the larger shingle counts of two word arrays."""
    def share(x: Column, y: Column) -> Column:
        both = F.aggregate(F.array_distinct(x), F.lit(0), lambda acc, s: acc + F.least(
            F.size(F.filter(x, lambda t: t == s)), F.size(F.filter(y, lambda t: t == s))))
        total = F.size(x) + F.size(y)
        return F.transform(F.array(both), lambda n: F.when(total > n, n / (total - n))
                           .otherwise(F.lit(0.0)))[0]

    # the shingles are lambda variables: made once, not for every shingle they are compared with
    pair = F.array(F.struct(shingle_texts(a, F.lit(width)).alias("x"),
                            shingle_texts(b, F.lit(width)).alias("y")))
    return F.transform(pair, lambda p: share(p.x, p.y))[0]


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated ones; all columns and all other rows stay."""
    key = free_name(docs, "_hit")
    hit = matches(docs, benchmark, id_col, text_col, **options)
    hit = materialise(hit.select(F.col("doc_key").alias(key)).distinct(), "contaminated")
    return docs.withColumn(key, doc_key(id_col, text_col)).join(
        bounded_broadcast(hit), key, "left_anti").select(docs.columns)
