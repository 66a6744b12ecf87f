"""Merkle manifest of a dataset with nested-interval labels.

Leaves of a source are ranked by id. A node at level l carries the interval [lo, hi) of leaf
ranks it covers: ``FANOUT ** l`` of them, fewer at the right edge. The digest of an inner node is
the SHA-256 of its children's hex digests, in order. The roots of the sources, ranked by source,
are the leaves of one more tree, built the same way.

Intervals stand for tree edges. Going down, the children of a parent are the intervals inside
its own, and a node's siblings are what is left of the parent's interval without the node's: the
ones that end at or before its lo are left of it, those that start at or after its hi right of
it. A node meets its parent in a join on level bucket (lo divided by the parent's width) with
containment as the condition, so a bucket holds one parent and at most ``FANOUT`` nodes, however
large the source. A path is the (left, right) siblings of every level up to the root; it is made
once per parent of leaves and handed to the leaves in the last join.

Texts stay in the scan: what is ranked, joined and shuffled is an id, a rank and digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import BROADCAST_ROWS, join_split, materialise
from eventide.operators.scan import prefix_scan
from eventide.sources.tables import spread

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NO_PATH = "cast(array() as array<struct<left:string,right:string>>)"


def field(c: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaf_digest(fields: list[Column]) -> Column:
    return digest(*map(field, fields))


def _group_of(c: Column) -> Column:
    """A value as a name that is never null and sorts the same way, null first."""
    return F.coalesce(F.concat(F.lit("+"), c.cast("string")), F.lit(""))


def _ordinal(df: DataFrame, col: str) -> Column:
    """A number that rises with ``col``, roughly: itself, or a string's first six bytes."""
    if isinstance(df.schema[col].dataType, T.NumericType):
        return F.col(col)
    head = F.rpad(F.substring(F.col(col).cast("binary"), 1, 6), 6, F.lit(b"\0"))
    return F.conv(F.hex(head), 16, 10).cast("double")


def ranked(df: DataFrame, group: str, order: list[str], unique: str) -> DataFrame:
    """``df`` with rank, the gapless place from 0 in its group by ``order`` (the first column
    numeric), rows equal in it by ``unique``; a hot group is ranked by many tasks."""
    numbered = prefix_scan(df, [group], [*order, unique],
                           {"rank": ("count", F.lit(1))})
    return numbered.withColumn("rank", (F.col("rank") - 1).cast("long"))


def _children(digests: Column) -> Column:
    return F.transform(digests, lambda c: c["digest"])


def levels_of(leaves: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """``leaves`` (group, rank, digest) to one table per level, lowest first: group, lo, hi,
    digest, n (leaves of the group), and above the leaves children (lo, hi, digest; in order).
    A group stops at the level where one node is left of it."""
    whole = leaves.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    whole = materialise(whole, "merkle-groups")
    few = whole.count() <= BROADCAST_ROWS
    sized = leaves.join(F.broadcast(whole), "group") if few else join_split(
        leaves, whole, "group")
    below = sized.select(
        "group", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest", "n")
    out, width = [materialise(below, "merkle-leaves")], fanout
    while True:
        child = F.struct("lo", "hi", "digest")
        up = (out[-1].where(F.col("n") > width // fanout)
                     .groupBy("group", "n", F.floor(F.col("lo") / width).alias("bucket"))
                     .agg(F.array_sort(F.collect_list(child)).alias("children"))
                     .select("group", (F.col("bucket") * width).alias("lo"),
                             F.least("n", (F.col("bucket") + 1) * width).alias("hi"),
                             digest(F.array_join(_children(F.col("children")), ""))
                             .alias("digest"), "n", "children"))
        up = materialise(up, "merkle-level")
        if up.isEmpty():
            return out
        out.append(up)
        width *= fanout


def roots_of(levels: list[DataFrame]) -> DataFrame:
    """The top node of every group: group, digest."""
    tops = [t.where((F.col("lo") == 0) & (F.col("hi") == F.col("n"))).select(
        "group", "digest", F.lit(k).alias("level")) for k, t in enumerate(levels)]
    out = tops[0]
    for t in tops[1:]:
        out = out.union(t)
    # a run of one node has its parent over the same interval: the highest level counts
    return out.groupBy("group").agg(F.max_by("digest", "level").alias("digest"))


def paths_of(levels: list[DataFrame], above: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Where the leaves' paths come from, one row per parent of leaves: group, bucket, lo, hi,
    children, path (left and right hex digests of every level above the children, lowest first)
    and the other columns of ``above``. ``above`` (group, path, ...) continues the path beyond
    the group's root. A group of one leaf has no parent: its row has no children."""
    more = [c for c in above.columns if c not in ("group", "path")]
    single = levels[0].where("n = 1").select("group", "lo", "hi").join(above, "group")
    kind = "array<struct<lo:bigint,hi:bigint,digest:string>>"
    alone = single.select("group", F.lit(0).cast("long").alias("bucket"), "lo", "hi",
                          F.lit(None).cast(kind).alias("children"), "path", *more)
    paths = None
    for k in range(len(levels) - 1, 0, -1):
        table, width = levels[k], fanout ** k
        top = table.where(F.col("n") <= width).join(above, "group")
        found = top.select("group", "lo", "hi", "children", "path", *more)
        if paths is not None:
            # a node lies in the parent of its level bucket whose interval contains its own
            node = table.where(F.col("n") > width).select(
                "group", F.floor(F.col("lo") / (width * fanout)).alias("bucket"), "lo", "hi",
                "children")
            found = found.union(attach(node, paths).select(
                "group", "lo", "hi", "children", "path", *more))
        paths = materialise(
            found.withColumn("bucket", F.floor(F.col("lo") / width)), "merkle-paths")
    return alone if paths is None else paths.select(alone.columns).union(alone)


def attach(nodes: DataFrame, parents: DataFrame) -> DataFrame:
    """``nodes`` (group, bucket, lo, hi, ...) with their path and the further columns of their
    ``parents``: the level-bucketed containment join, and the interval difference."""
    own = [F.col(f"c.{c}").alias(c) for c in nodes.columns]
    more = [F.col(f"p.{c}").alias(c) for c in parents.columns
            if c not in ("group", "bucket", "lo", "hi", "children", "path")]
    met = nodes.alias("c").join(
        parents.alias("p"), (F.col("c.group") == F.col("p.group"))
        & (F.col("c.bucket") == F.col("p.bucket"))
        & (F.col("c.lo") >= F.col("p.lo")) & (F.col("c.hi") <= F.col("p.hi")))
    step = F.array(_siblings("p.children", "c.lo", "c.hi"))
    path = F.when(F.col("p.children").isNull(), F.col("p.path")).otherwise(
        F.concat(step, F.col("p.path")))
    return met.select(*own, path.alias("path"), *more)


def _siblings(children: str, lo: str, hi: str) -> Column:
    """The parent's interval without [lo, hi): the digests left and right of it."""
    def joined(keep) -> Column:
        return F.array_join(_children(F.filter(children, keep)), "")

    return F.struct(joined(lambda c: c["hi"] <= F.col(lo)).alias("left"),
                    joined(lambda c: c["lo"] >= F.col(hi)).alias("right"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give. A level without siblings hashes the node
    alone."""
    return F.aggregate(path, leaf, lambda acc, s: digest(s["left"], acc, s["right"]))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""),
                  256)


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source",
             fields: tuple[str, ...] = FIELDS, tampered: Column | None = None,
             text_col: str = "text", fanout: int = FANOUT) -> DataFrame:
    """One row per input row: doc_id, leaf, subroot, root, proof_sha256, path (left and right
    siblings of each level), folded_root and verified. ``tampered``: where it holds, the root is
    folded from the leaf with its text's A-Z lower-cased (a null text stays).

    Nulls are written ``-`` and hash like any value; a null id or source comes first; rows with
    one id stand in the order of their leaves, and rows that repeat in every field are leaves of
    their own; an empty table gives no rows; texts of any length are hashed whole; other columns
    are not read.
    """
    wrong = F.lit(False) if tampered is None else tampered
    rows = spread(docs.select(
        F.col(id_col).alias("doc_id"), _group_of(F.col(group_col)).alias("group"),
        wrong.alias("wrong"), *[F.col(f).alias(f"f{i}") for i, f in enumerate(fields)]))
    cols = [F.col(f"f{i}") for i in range(len(fields))]
    changed = [ascii_lower(c) if f == text_col else c for c, f in zip(cols, fields, strict=True)]
    leaves = rows.select("doc_id", "group", leaf_digest(cols).alias("leaf"),
                         F.when(F.col("wrong"), leaf_digest(changed)).alias("shown"))
    leaves = materialise(leaves.withColumn("at", _ordinal(leaves, "doc_id")), "merkle-digests")
    leaves = materialise(ranked(leaves, "group", ["at", "doc_id"], "leaf").drop("at"),
                         "merkle-ranked")
    levels = levels_of(leaves.select("group", "rank", F.col("leaf").alias("digest")), fanout)
    subroots = materialise(roots_of(levels), "merkle-subroots")
    trees = materialise(_source_order(subroots), "merkle-sources")
    upper = levels_of(trees.select(F.lit("").alias("group"), "rank", "digest"), fanout)
    nothing = trees.where("rank = 0").select(F.lit("").alias("group"),
                                             F.expr(NO_PATH).alias("path"))
    node = _as_nodes(trees.withColumnRenamed("group", "name"), fanout).withColumn(
        "group", F.lit(""))
    above = attach(node, paths_of(upper, nothing, fanout)).select(
        F.col("name").alias("group"), "path", F.col("digest").alias("subroot"),
        fold(F.col("digest"), F.col("path")).alias("root"))
    paths = paths_of(levels, materialise(above, "merkle-above"), fanout)
    return attach(_as_nodes(leaves, fanout), paths).select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        "path", fold(F.coalesce("shown", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _as_nodes(leaves: DataFrame, fanout: int) -> DataFrame:
    return leaves.withColumns({"lo": F.col("rank"), "hi": F.col("rank") + 1,
                               "bucket": F.floor(F.col("rank") / fanout)})


def _source_order(subroots: DataFrame) -> DataFrame:
    """``subroots`` with rank, their place by source. Sources are cut by their first bytes and
    numbered inside the cuts."""
    cut = F.substring(F.col("group").cast("binary"), 1, 3)
    own = subroots.withColumn("_cut", F.hex(cut))
    sizes = own.groupBy("_cut").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_cut", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    within = F.row_number().over(Window.partitionBy("_cut").orderBy("group")) - 1
    return (own.withColumn("_rn", within).join(offsets, "_cut")
               .select("group", "digest", (F.col("_off") + F.col("_rn")).cast("long")
                       .alias("rank")))
