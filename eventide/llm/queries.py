"""One query per text operator, applied to its whole table, with oracle SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import (chat_format, decontaminate, exact_dedup, langid, license_scan, merkle,
                          minhash_dedup, mixing, prefix_trie, quality, sharding, simhash_dedup,
                          toxicity)
from eventide.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    return langid.identify(read_table(spark, sf_dir, "documents"))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, with the number of offending tokens."""
    scored = toxicity.detect(read_table(spark, sf_dir, "documents"),
                             read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted",
                         F.size("spans").alias("n_spans"))


@query
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed to their sources' targets, in training order."""
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixing.training_order(mixed).select(
        "doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL["op3_source_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))) AS h,
         coalesce(text, '') AS text
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS DOUBLE)
               AS weight, CAST(3 * source_size AS DOUBLE) AS cap FROM s),
l AS (SELECT *, cap / weight AS ratio,
        (sum(CAST(source_size AS DOUBLE)) OVER () - coalesce(sum(cap) OVER (
           ORDER BY cap / weight, source IS NULL, source
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER (
           ORDER BY cap / weight, source IS NULL, source
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM w),
f AS (SELECT arg_min(level, ratio) AS lv FROM l WHERE level <= ratio),
t AS (SELECT source, source_size, least(cap, coalesce(lv * weight, cap)) AS target FROM l, f),
r AS (SELECT d.*, t.source_size, t.target, CAST(sum(d.size) OVER (
        PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - d.size AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, CAST(floor(target) AS BIGINT) AS words,
             CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0
             END AS passes FROM r)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(passes * size + least(greatest(words - passes * source_size - before, 0), size)
            AS BIGINT) AS taken
FROM p"""


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return quality.classify(read_table(spark, sf_dir, "documents"),
                            read_table(spark, sf_dir, "labels"))


@query
def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return simhash_dedup.near_duplicate_groups(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id", "component_size")


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and the best window."""
    return decontaminate.matches(read_table(spark, sf_dir, "documents"),
                                 read_table(spark, sf_dir, "benchmark")).drop("doc_key")


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicate groups of all documents."""
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


ORACLE_SQL["op7_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))"""


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))


PROBE = f"{chat_format.END}{chat_format.START}assistant ok"


@query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are control strings, rendered and read back."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"))
    back = chat_format.read_back(chat_format.format_conversations(turns.unionByName(probe)))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(
        t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(digest, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE_SQL["op8_chat_format"] = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}')),
e AS (SELECT *, length(replace(replace(text, '\\', '\\b'), '<|', '<\\|')) AS n,
  length(replace(replace(replace(role, '\\', '\\b'), '<|', '<\\|'), chr(10), '\\n')) AS m FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), ''
              ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
              FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({len(chat_format.START)} + m + 1 + n + {len(chat_format.END)} + 1) AS BIGINT)
         AS formatted_chars
FROM e GROUP BY conv_id"""


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of a two-region tree, and where a ninth would take them."""
    return sharding.shard_rows(read_table(spark, sf_dir, "documents"), sharding.tree(8))


@query
def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents by the similarity of their shingle sets."""
    return minhash_dedup.near_duplicate_groups(read_table(spark, sf_dir, "documents"))


ORACLE_SQL["op11_minhash_dedup"] = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, unnest(CASE WHEN len(w) > 1 THEN list_transform(
        range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS x FROM d),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
c AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.r < b.r
      GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.r = a JOIN n y ON y.r = b
      WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
t AS (SELECT r, r AS far FROM d UNION SELECT t.r, e.b FROM t JOIN e ON t.far = e.a),
m AS (SELECT t.r, min(d.doc_id) AS component_id FROM t JOIN d ON d.r = t.far GROUP BY t.r)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id,
       doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN m USING (r) LEFT JOIN n USING (r)"""


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of all documents, checked after every fifth one (by hash) was tampered with."""
    docs = read_table(spark, sf_dir, "documents")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return merkle.manifest(docs, tampered=tampered).drop("path")


#: Unsigned crc32 of ``{0}`` (ASCII text) in SQL: bit by bit, one list entry a step.
CRC32_SQL = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(
  list_transform(string_split({0}, ''), lambda c: [CAST(ord(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
  lambda a, c: xor(xor(a, c) >> 1, (xor(a, c) & 1) * 3988292384)))"""


def _merkle_sql(levels: int = 6, upper: int = 3) -> str:
    """Up to 16 ** levels leaves a source, 16 ** upper sources: one step per level."""
    def field(c: str) -> str:
        v = f"CAST({c} AS VARCHAR)"
        return f"coalesce(CAST(strlen({v}) AS VARCHAR) || ':' || {v}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(
            [*(field(c) for c in ("doc_id", "source", "lang", "n_chars")), field(text)]) + ")"

    def climb(first: int, last: int) -> str:
        out = ""
        for k in range(first, last):
            out += f"""
r{k} AS (SELECT g, i // 16 AS j, list(d ORDER BY i) AS ch FROM n{k} WHERE g IN (
           SELECT g FROM n{k} GROUP BY g HAVING count(*) > 1) GROUP BY ALL),
n{k + 1} AS (SELECT g, j AS i, sha256(array_to_string(ch, '')) AS d FROM r{k} UNION ALL
             SELECT g, i, d FROM n{k} WHERE g NOT IN (SELECT g FROM r{k})),
p{k + 1} AS (
  SELECT p{k}.* EXCLUDE (i, proof, fold), if(ch IS NULL, i, i // 16) AS i,
    if(ch IS NULL, proof, proof || array_to_string(ch[1:i % 16], '')
                                || array_to_string(ch[i % 16 + 2:], '')) AS proof,
    if(ch IS NULL, fold, sha256(array_to_string(ch[1:i % 16], '') || fold
                                || array_to_string(ch[i % 16 + 2:], ''))) AS fold
  FROM p{k} LEFT JOIN r{k} ON r{k}.g = p{k}.g AND r{k}.j = p{k}.i // 16),"""
        return out

    top = levels + 1 + upper
    return f"""
WITH l AS (
  SELECT doc_id, coalesce('+' || source, '') AS g, {leaf('text')} AS leaf,
         CASE WHEN {CRC32_SQL.format("CAST(doc_id AS VARCHAR)")} % 5 = 0
              THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
         END AS shown FROM documents),
p0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
              '' AS proof, coalesce(shown, leaf) AS fold FROM l),
n0 AS (SELECT g, i, leaf AS d FROM p0),{climb(0, levels)}
u AS (SELECT g, d AS subroot, row_number() OVER (ORDER BY g) - 1 AS place FROM n{levels}),
n{levels + 1} AS (SELECT '' AS g, place AS i, subroot AS d FROM u),
p{levels + 1} AS (SELECT doc_id, leaf, subroot, '' AS g, place AS i, proof, fold
                  FROM p{levels} JOIN u USING (g)),{climb(levels + 1, top)}
e AS (SELECT d AS root FROM n{top})
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root,
       fold = root AS verified FROM p{top}, e"""


ORACLE_SQL["op12_merkle_manifest"] = _merkle_sql()


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all rebuilt conversations, one row per node."""
    return prefix_trie.conversation_trie(read_table(spark, sf_dir, "conversations")).drop("node")


ORACLE_SQL["op13_prefix_trie"] = rf"""
WITH t AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name) AS pos
  FROM (SELECT conv_id, turn, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+'))
                 AS words,
               sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '')
                      || coalesce(text, '')) AS name FROM conversations)),
c AS (SELECT DISTINCT conv_id, {CRC32_SQL.format("CAST(conv_id AS VARCHAR)")} % 4 AS h
      FROM conversations),
r AS (SELECT c.conv_id, 0 AS part, pos, name, words
      FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 WHERE pos <= h
      UNION ALL SELECT c.conv_id, 1, pos, name, words FROM c JOIN t USING (conv_id) WHERE pos > h),
m AS (SELECT conv_id, 0 AS depth, '' AS prefix, 0 AS words FROM c UNION ALL
      SELECT conv_id, row_number() OVER w, string_agg(name, '') OVER w, words FROM r
      WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)),
n AS (SELECT prefix, max(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
             max(words) AS words FROM m GROUP BY prefix),
k AS (SELECT left(prefix, len(prefix) - 64) AS prefix, count(*) AS n_children FROM n
      WHERE depth > 0 GROUP BY 1),
e AS (SELECT prefix, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends
      FROM (SELECT conv_id, arg_max(prefix, depth) AS prefix FROM m GROUP BY conv_id) GROUP BY 1),
s AS (SELECT a.prefix, sum((b.n_convs - 1) * b.words) AS saved,
             count(*) FILTER (b.prefix NOT IN (SELECT prefix FROM k)) AS n_leaves
      FROM n a JOIN n b ON starts_with(b.prefix, a.prefix) GROUP BY 1)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       coalesce(ends, sha256('')) AS ends_sha256
FROM n JOIN s USING (prefix) LEFT JOIN k USING (prefix) LEFT JOIN e USING (prefix)
LEFT JOIN n p ON n.depth > 0 AND p.prefix = left(n.prefix, len(n.prefix) - 64)"""
