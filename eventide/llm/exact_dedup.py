"""Exact duplicates by content-defined chunk recipes.

A text is cut where its own content says so: a chunk ends after at least ``MIN_CHUNK``
characters at the first white space that follows one of the boundary characters, at the end of
the text, or after ``MAX_CHUNK`` characters. Passages shared by different documents therefore
give the same chunks wherever they stand. Distinct chunks are gathered once, by value, and each
gets a verified identifier: its 64-bit hash, extended by a rank if two different chunks share a
hash. A document is then its recipe, the ordered list of identifiers; recipes are equal exactly
when the texts are. Long texts move through at most one shuffle, as chunks that are combined on
the map side; everything after that moves eight bytes a chunk.

All steps are DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import id_and_text, materialise

MIN_CHUNK, MAX_CHUNK = 512, 4096
#: A chunk may end at white space after one of these characters.
BOUNDARY_AFTER = r"[bcdfgkpqvwxz0-9.!?;:,。！？।]"
CHUNK = (rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?(?:{BOUNDARY_AFTER}\s|\z)"
         rf"|.{{1,{MAX_CHUNK}}}")

NO_FIX = "cast(array() as array<array<bigint>>)"


def chunk_list(text: Column) -> Column:
    """The text's chunks in order; joined again they are the text."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            chunk_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per input row: row_no, doc_id, text_sha256, recipe (chunk hashes in order) and
    fix ([position, rank] of the chunks that share their hash with another; mostly none)."""
    rows = id_and_text(docs, id_col, text_col)
    made = materialise(
        rows.select(F.monotonically_increasing_id().alias("row_no"), "doc_id",
                    F.sha2(F.col("text"), 256).alias("text_sha256"),
                    F.transform(chunk_list(F.col("text")), lambda c: chunk_hash(c))
                     .alias("recipe")),
        "recipes")
    chunk = (rows.select(F.explode(chunk_list(F.col("text"))).alias("chunk"))
                 .select(chunk_hash(F.col("chunk")).alias("h"), "chunk"))
    distinct = chunk.groupBy("h", "chunk").agg(F.count(F.lit(1)).alias("uses"))
    clash = materialise(distinct.groupBy("h").agg(F.count(F.lit(1)).alias("texts"))
                        .where("texts > 1").select("h"), "chunk-clash")
    if clash.isEmpty():  # every hash stands for one chunk: verified, hashes are identifiers
        return made.withColumn("fix", F.expr(NO_FIX))

    rank = F.row_number().over(Window.partitionBy("h").orderBy("chunk")).cast("long")
    ranks = distinct.join(clash, "h", "left_semi").select("h", "chunk", rank.alias("rank"))
    used = (rows.select("doc_id", F.sha2(F.col("text"), 256).alias("text_sha256"),
                        F.posexplode(chunk_list(F.col("text"))).alias("pos", "chunk"))
                .withColumn("h", chunk_hash(F.col("chunk"))))
    fixes = (used.join(ranks, ["h", "chunk"])
                 .select("text_sha256", F.array(F.col("pos").cast("long"), "rank").alias("p"))
                 .distinct()
                 .groupBy("text_sha256").agg(F.array_sort(F.collect_list("p")).alias("fix")))
    return made.join(fixes, "text_sha256", "left").select(
        *made.columns, F.coalesce("fix", F.expr(NO_FIX)).alias("fix"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 chunk_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; a null text counts as empty, and the empty texts form a
    group like any other. Of a group the row with the largest doc_id stays. A null id is
    smaller than any other. Of repeated rows (same id, same text) exactly one is kept. An empty
    table gives an empty result; texts of any length are read whole; further columns of ``docs``
    are not read.
    """
    made = recipes(docs, id_col, text_col, chunk_hash)
    key = ["recipe", "fix"]
    groups = made.groupBy(*key).agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
        F.coalesce(F.max_by("row_no", "doc_id"), F.max("row_no")).alias("_keep_row"))
    return (made.join(groups, key)
                .select("doc_id", "keep_id", "group_size",
                        (F.col("row_no") == F.col("_keep_row")).alias("kept"), "text_sha256"))
