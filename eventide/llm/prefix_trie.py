"""Prefix trie of conversations by whole-sequence collapse.

A turn is named by the SHA-256 of its role and text; a prefix by the digest chain of its turns.
Identical rebuilt conversations collapse to one weighted sequence with a list of who ends there.
A sequence that is a proper prefix of another one is no leaf: an anti-join against all proper
prefixes leaves the leaves. Nodes are the prefixes of the distinct sequences, aggregated with
their weights.

Sums over subtrees stay linear in the turns. Every node is owned by the least leaf sequence that
runs through it, so a leaf owns a lower stretch of its own path, and the sum over a node's subtree
is what the leaves below it own in total, less what the node's owner owns above the node:
each leaf sends its total to its prefixes once, and one running sum per owner gives the rest.

Texts stay in the scan. A conversation's turn digests are gathered in one row (the sequence is
the unit of the method), and nothing else is gathered by conversation. Many conversations that
end at one node are listed in pieces by id range; only the pieces pass through one task, as a
stream, because SHA-256 is serial.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import WORD, join_split, materialise
from eventide.sources.tables import spread

ROOT = hashlib.sha256(b"").hexdigest()
#: Ids in one piece of an end list, at most: a piece holds an id range of this width.
PIECE = 4096


def turn_name(role: Column, text: Column) -> Column:
    """Hex SHA-256 of a turn; the role's length keeps role and text apart."""
    return F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)


def sequences(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
              role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, turns (array of name, words; by turn, null first, then
    by name)."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = spread(conversations.select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        role.alias("role"), text.alias("text"))).select(
            "conv_id", "turn", turn_name(F.col("role"), F.col("text")).alias("name"),
            F.size(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("words"))
    ordered = F.array_sort(F.collect_list(F.struct("turn", "name", "words")))
    return rows.groupBy("conv_id").agg(ordered.alias("t")).select(
        "conv_id", F.transform(_nulls_first("t"), lambda t: F.struct(
            t["name"].alias("name"), t["words"].alias("words"))).alias("turns"))


def _nulls_first(turns: str) -> Column:
    return F.concat(F.filter(turns, lambda t: t["turn"].isNull()),
                    F.filter(turns, lambda t: t["turn"].isNotNull()))


def rebuilt(seqs: DataFrame, block: int = 20, heads: int = 4) -> DataFrame:
    """Every conversation c with its first h turns replaced by those of conversation
    c - c % ``block`` (all if it has fewer, none if it is absent); h is the unsigned crc32 of the
    decimal id modulo ``heads`` (0 for a null id)."""
    h = F.coalesce(F.crc32(F.col("conv_id").cast("string")) % heads, F.lit(0)).cast("int")
    own = seqs.withColumn("h", h).withColumn(
        "base", F.col("conv_id") - F.col("conv_id") % block)
    base = seqs.select(F.col("conv_id").alias("base"),
                       F.slice("turns", 1, heads - 1).alias("head"))
    none = F.array().cast(seqs.schema["turns"].dataType)
    return own.join(base, "base", "left").select("conv_id", F.concat(
        F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
        F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


def collapse(convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct sequences (seq, chain: the names of its prefixes from the root on, words: of the
    last turn of each, n_convs, least) and who ends where (seq, conv_id)."""
    chain = F.aggregate(
        "turns", F.array(F.lit(ROOT)), lambda acc, t: F.concat(acc, F.array(F.sha2(F.concat(
            F.element_at(acc, -1), t["name"]), 256))))
    named = convs.select("conv_id", chain.alias("chain"), F.concat(
        F.array(F.lit(0)), F.transform("turns", lambda t: t["words"])).alias("words"))
    named = materialise(named.select("conv_id", F.element_at("chain", -1).alias("seq"), "chain",
                                     "words"), "trie-chains")
    weights = named.groupBy("seq").agg(F.count(F.lit(1)).alias("n_convs"),
                                       F.min("conv_id").alias("least"))
    weights = materialise(weights, "trie-weights")
    # the sequence itself is that of its smallest member; no copy of it moves
    one = named.join(weights, (named.seq == weights.seq)
                     & named.conv_id.eqNullSafe(weights.least)).select(
        weights.seq, "chain", "words", "n_convs", "least")
    return materialise(one, "trie-sequences"), named.select("seq", "conv_id")


def leaf_sequences(seqs: DataFrame) -> DataFrame:
    """Sequences that are no proper prefix of another one."""
    inner = seqs.select(F.explode(F.slice("chain", F.lit(1), F.size("chain") - 1)).alias("seq"))
    return seqs.join(inner.distinct(), "seq", "left_anti")


def ends_digest(ends: DataFrame, piece: int = PIECE) -> DataFrame:
    """``ends`` (seq, conv_id) to seq and ends_sha256: SHA-256 of the decimal ids, ascending,
    joined by commas (a null id is written ``null``, first). A list is written in pieces by id
    range, which are hashed one after the other."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")),
                                    lambda c: c.cast("string")), ",")
    pieces = (ends.groupBy("seq", F.floor(F.col("conv_id") / piece).alias("at"))
                  .agg(F.when(F.col("at").isNull(), F.array_join(F.array_repeat(
                      F.lit("null"), F.count(F.lit(1)).cast("int")), ","))
                      .otherwise(text).alias("ids"))
                  .repartition("seq").sortWithinPartitions("seq", F.col("at").asc_nulls_first()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            done = []
            for s, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                              strict=True):
                if s == last:
                    state.update(b",")
                else:
                    if last is not None:
                        done.append((last, state.hexdigest()))
                    last, state = s, hashlib.sha256()
                state.update(ids.encode())
            yield _pairs(done)
        if last is not None:
            yield _pairs([(last, state.hexdigest())])

    return pieces.select("seq", "ids").mapInArrow(run, "seq string, ends_sha256 string")


def _pairs(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())],
        ["seq", "ends_sha256"])


def trie(convs: DataFrame) -> DataFrame:
    """``convs`` (conv_id, turns: array of name and words) to one row per node: node (the
    prefix's digest), conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. Members are the conversations that start with the node's
    prefix; an empty table has no root."""
    seqs, ends = collapse(convs)
    leaves = materialise(leaf_sequences(seqs).select("seq"), "trie-leaves")
    marked = seqs.join(leaves.withColumn("leaf", F.lit(1)), "seq", "left")
    at = F.arrays_zip("chain", "words")
    steps = marked.select("seq", "n_convs", "least", "leaf", "chain",
                          F.posexplode(at).alias("depth", "z"))
    steps = steps.select("seq", "n_convs", "least", "leaf", "depth", F.col("z.chain").alias("node"),
                         F.col("z.words").alias("words"),
                         F.get("chain", F.col("depth") - 1).alias("parent"))
    nodes = steps.groupBy("node").agg(
        F.sum("n_convs").alias("n_convs"), F.min("least").alias("conv_id"),
        F.count("leaf").alias("n_leaves"), F.max("depth").alias("depth"),
        F.max("words").alias("words"), F.max("parent").alias("parent"),
        F.min(F.when(F.col("leaf") == 1, F.col("seq"))).alias("owner"))
    nodes = materialise(nodes.withColumn("own", (F.col("n_convs") - 1) * F.col("words")),
                        "trie-nodes")
    # what the owner owns above the node, and in total
    path = Window.partitionBy("owner").orderBy("depth")
    owned = nodes.withColumn("above", F.coalesce(F.sum("own").over(
        path.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    totals = nodes.groupBy(F.col("owner").alias("seq")).agg(F.sum("own").alias("total"))
    sent = (seqs.join(totals.where("total > 0"), "seq")
                .select("total", F.explode("chain").alias("node"))
                .groupBy("node").agg(F.sum("total").alias("below")))
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("node").alias("parent"),
                           F.col("conv_id").alias("parent_conv_id"))
    with_parent = join_split(
        owned.select("node", "parent", "conv_id", "depth", "n_convs", "n_leaves", "above"),
        parents, "parent", "left", counted=nodes)
    lists = ends_digest(ends)
    return (with_parent.join(children, "node", "left").join(sent, "node", "left")
            .join(lists.withColumnRenamed("seq", "node"), "node", "left")
            .select("node", "conv_id", F.col("depth").cast("long").alias("depth"),
                    "parent_conv_id", "n_convs",
                    F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
                    "n_leaves",
                    F.when(F.col("below").isNull(), 0).otherwise(F.col("below") - F.col("above"))
                     .cast("long").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(ROOT)).alias("ends_sha256")))


def conversation_trie(conversations: DataFrame, **columns) -> DataFrame:
    """The trie of the rebuilt ``conversations`` (conv_id, turn, role, text).

    Turns are ordered by turn, null first, rows with one turn by the digest of role and text; a
    null role or text counts as empty; repeated rows are turns of their own; null conversation
    ids form one conversation, which is rebuilt from itself, is the smallest member only if it is
    the only one and is written ``null`` in end lists; an empty table gives no rows; texts of any
    length are read whole; other columns are not read.
    """
    return trie(rebuilt(sequences(conversations, **columns)))
