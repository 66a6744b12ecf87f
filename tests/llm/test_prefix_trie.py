"""Conversation prefix trie against a trie built in plain Python."""

import hashlib
import random
import re
import zlib

from pyspark.sql import functions as F

from eventide.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string"


def table(spark, rows, extra=()):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in extra])


def name(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(rows, block=20, heads=4):
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    for v in convs.values():
        v.sort(key=lambda t: (t[0], t[1], name(t[2], t[3])))
    rebuilt = {}
    for c, v in convs.items():
        h = zlib.crc32(str(c).encode()) % heads if c is not None else 0
        base = [] if c is None else convs.get(c - int(c - block * int(c / block)), [])
        rebuilt[c] = [t[2:] for t in base[:h] + v[h:]]
    members, ends = {}, {}
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
        ends.setdefault(tuple(v), []).append(c)

    def least(ids):
        return min((x for x in ids if x is not None), default=None)

    out = []
    for node, ids in members.items():
        below = [m for m in members if m[:len(node)] == node]
        children = [m for m in below if len(m) == len(node) + 1]
        saved = sum((len(members[m]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", m[-1][1]))
                    for m in below if m)
        leaves = sum(not any(len(x) == len(m) + 1 and x[:-1] == m for x in below) for m in below)
        own = sorted(ends.get(node, []), key=lambda x: (x is not None, x or 0))
        text = ",".join("null" if x is None else str(x) for x in own)
        out.append((least(ids), len(node), least(members[node[:-1]]) if node else None, len(ids),
                    len(children), leaves, saved, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def run(df):
    cols = ("conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens "
            "ends_sha256").split()
    return sorted((tuple(r) for r in P.conversation_trie(df).select(cols).collect()), key=str)


def sample(seed=1, n=90):
    """Few different turns, so that conversations share prefixes and whole sequences."""
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(200), n):
        for t in range(r.choice([1, 1, 2, 3, 5, 8])):
            rows.append((c, t, ("user", "assistant")[t % 2], r.choice(["a b", "c", "", "d  e\tf"])))
    r.shuffle(rows)
    return rows


def test_nodes_are_those_of_a_plain_trie(spark):
    rows = sample()
    assert run(table(spark, rows)) == brute(rows)


def test_a_long_conversation_and_many_equal_ones(spark):
    rows = [(5, t, "user", f"turn {t} of it") for t in range(400)]
    rows += [(40 + c, t, "user", f"same {t}") for c in range(60) for t in range(3)]
    rows += [(5000 + 7000 * c, 0, "user", "far apart") for c in range(30)]
    assert run(table(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None, "user", "x y"), (1, 0, None, None), (1, 0, "user", "b"), (1, 0, "user", "b"),
            (None, 0, "user", "no id"), (None, None, None, ""), (-7, 0, "user", "x y"),
            (-27, 0, "user", "x y"), (20, 0, "user", "z"), (21, 0, "system", "z"),
            (22, 3, "user", "퟿ naïve " * 2000), (2 ** 62, 1, "user", "big id")]
    got = run(table(spark, rows, ["seq", "node", "depth", "words", "owner", "turns"]))
    assert got == brute(rows)


def test_a_conversation_may_be_rebuilt_to_nothing(spark):
    # its own turns are cut off and the base is absent: a member of the root alone
    c = next(c for c in range(1, 99) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(c, 0, "user", "gone"), (c, 1, "user", "gone"), (200, 0, "user", "stays")]
    got = run(table(spark, rows))
    assert got == brute(rows)
    assert {r[1] for r in got if r[0] == c} == {0}


def test_empty_table(spark):
    assert run(table(spark, [])) == []


def test_end_lists_go_in_pieces(spark):
    ids = [0, 3, 4, 9, 10, 11, 57, 1000, -5, -1]
    df = spark.createDataFrame([("s", i) for i in ids] + [("t", 1), ("t", None)],
                               "seq string, conv_id long")
    want = {"s": ",".join(map(str, sorted(ids))), "t": "null,1"}
    for piece in (2, 10, 4096):
        got = {r.seq: r.ends_sha256 for r in P.ends_digest(df, piece).collect()}
        assert got == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}


def test_role_and_text_are_kept_apart(spark):
    df = table(spark, [(20, 0, "us", "er"), (40, 0, "use", "r")])
    assert {r[1] for r in run(df)} == {0, 1}
    assert len(run(df)) == 3


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert run(df) == brute(rows)
