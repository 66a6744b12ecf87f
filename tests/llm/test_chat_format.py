"""Chat formatting: folding events, rendering, and exact round trips."""

import random

from eventide.llm import chat_format as C

PIECES = ["<|im_end|>", "<|im_start|>", "<|", "<\\|", "\\", "\\b", "\\n", "|>", "|", "<", "\n", "a",
          "é", "\U0001f600", " ", ""]


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def back(df):
    return {r.conv_id: r for r in C.read_back(C.format_conversations(df)).collect()}


def test_round_trip_of_hostile_texts(spark):
    r = random.Random(3)
    rows = [(c, t, r.choice(["user", "assistant", "system", "a\nb", "<|im_end|>", "x\\n"]),
             "".join(r.choice(PIECES) for _ in range(r.randint(0, 9))))
            for c in range(40) for t in range(r.randint(1, 6))]
    got = back(table(spark, rows))
    for c in range(40):
        want = [(role, text) for cc, _, role, text in rows if cc == c]
        assert [(t.role, t.text) for t in got[c].turns] == want
        assert got[c].loss_text == "".join(x for role, x in want if role == "assistant")
        assert got[c].formatted.count(C.END + "\n") == len(want)


def test_nulls_ties_repeats_and_long_texts(spark):
    long = "word " * 100_000
    rows = [(1, 0, None, None), (1, 0, "user", "b"), (1, 0, "user", "b"), (1, None, "user", "a"),
            (None, 0, "assistant", "x"), (2, 0, "assistant", long), (2, 1, "assistant", None)]
    got = back(table(spark, rows).selectExpr("*", "1 as message", "2 as seq", "3 as kind"))
    assert [(t.role, t.text) for t in got[1].turns] == [
        ("user", "a"), ("", ""), ("user", "b"), ("user", "b")]
    assert got[None].loss_text == "x"
    assert got[2].loss_text == long and len(got[2].turns) == 2


def test_events_fold(spark):
    ev = spark.createDataFrame(
        [(1, 0, 1, 0, "open", "user", ""), (1, 0, 1, 1, "delta", None, "helo"),
         (1, 0, 1, 2, "edit", None, "hello"), (1, 0, 1, 3, "delta", None, "!"),
         (1, 1, 1, 0, "open", "assistant", ""), (1, 1, 1, 1, "delta", None, "first try"),
         (1, 1, 1, 2, "regenerate", None, None), (1, 1, 1, 4, "delta", None, "try"),
         (1, 1, 1, 3, "delta", None, "second "), (1, 1, 1, 5, "ping", None, "noise")],
        "conv_id long, turn long, message int, seq int, kind string, role string, text string")
    got = {r.turn: (r.role, r.text) for r in C.fold_events(ev).collect()}
    assert got == {0: ("user", "hello!"), 1: ("assistant", "second try")}


def test_the_log_is_streamed_and_folds_back(spark):
    rows = [(1, 0, "user", "x" * 1000), (1, 1, "assistant", "")]
    log = C.event_log(table(spark, rows), piece=64)
    assert log.where("kind = 'delta'").count() == 16
    got = {r.turn: r.text for r in C.fold_events(log).collect()}
    assert got == {0: "x" * 1000, 1: ""}


def test_empty_table(spark):
    assert back(table(spark, [])) == {}
