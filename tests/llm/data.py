"""Small tables for the text operators' tests."""

import random

WORDS = [a + b for a in "ba ce di fo gu ha je ki lo mu".split()
         for b in "ran sel tin vor wun nat res lip dom kus".split()]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def docs(spark, rows, more=()):
    """rows: (doc_id, text, lang, source) or shorter; ``more``: DDL of further columns, null."""
    rows = [tuple(r) + (None,) * (4 - len(r)) + (len(r[1] or ""),) for r in rows]
    df = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, kind in more:
        df = df.selectExpr("*", f"cast(null as {kind}) as {name}")
    return df


#: nulls in every column, empty and blank texts, a very long one, repeats and ties
def odd_rows(long=60_000):
    long = prose(1, long)
    return [(1, "", "en", "a"), (2, None, "en", "a"), (None, "a text without an id", None, None),
            (None, None, None, None), (3, " \t\n ", "en", "b"), (4, long, "en", "b"),
            (5, long, "en", "b"), (6, prose(2, 40), "en", "c"), (6, prose(2, 40), "en", "c"),
            (7, prose(2, 40), "de", "c"), (8, "?!", "de", None), (9, "\U0001f600 naïve é", "de", "é")]


#: names an operator uses for its own outputs or inside
CLASH = [("score", "string"), ("kept", "string"), ("shard", "string"), ("fp", "string"),
         ("size", "string"), ("taken", "string"), ("position", "string"), ("word", "string"),
         ("key", "string"), ("h", "string"), ("held_out", "string"), ("label", "string"),
         ("spans", "string"), ("item_id", "string"), ("component_id", "string"), ("_key", "string"),
         ("_hit", "string"), ("_at", "string"), ("doc_key", "string"), ("name", "string"),
         ("node", "string"), ("n", "string"), ("row_no", "string"), ("words", "string")]
