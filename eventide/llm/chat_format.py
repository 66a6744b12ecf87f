"""Chat formatting by event-sourced reconstruction.

A conversation is a log of events. ``open`` starts a message (its role), ``delta`` appends
streamed text, ``edit`` replaces what the message says so far, ``regenerate`` throws the draft
away so that later deltas build a new one. The log is folded per message, then the messages of a
conversation are put in order and rendered with a template whose control strings cannot occur in
a text: ``\\`` is written ``\\b`` and ``<|`` is written ``<\\|`` inside texts, which is undone
exactly when the output is read back.

All steps are DataFrame functions. A message is folded on its own, so the turns of one huge
conversation are spread over tasks; only its rendered string is put together in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Events that make everything earlier in the same message void.
RESETS = ("open", "edit", "regenerate")


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\|"), F.lit("|")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """A role stands on a line of its own, so a line feed inside it is escaped as well."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def event_log(conversations: DataFrame, piece: int = 256) -> DataFrame:
    """Stored turns as the log they were streamed by: an ``open`` and the text in deltas of
    ``piece`` characters. Rows of a conversation with the same turn stay apart (``message``
    numbers them by role and text); a null role or text counts as empty."""
    rows = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    nth = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    pieces = F.regexp_extract_all(F.col("text"), F.lit(f"(?s).{{1,{piece}}}"), F.lit(0))
    opened = F.array(F.struct(F.lit("open").alias("kind"), F.lit("").alias("text")))
    deltas = F.transform(pieces, lambda x: F.struct(F.lit("delta").alias("kind"),
                                                    x.alias("text")))
    return (rows.withColumn("message", nth)
                .select("conv_id", "turn", "message", "role",
                        F.posexplode(F.concat(opened, deltas)).alias("seq", "event"))
                .select("conv_id", "turn", "message", "seq", "event.kind",
                        "role", "event.text"))


def fold_events(events: DataFrame) -> DataFrame:
    """One row per message: conv_id, turn, message, role, text. ``seq`` orders the events of a
    message; the text is what its last open, edit or regenerate event and the deltas after it
    say. Events without a kind named above add nothing; the role is the last one not null."""
    by_seq = F.array_sort(F.collect_list(
        F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"))))
    last_reset = F.max(F.when(F.col("kind").isin(*RESETS), F.col("seq")))
    live = F.filter("log", lambda e: (F.col("base").isNull() | (e.seq >= F.col("base")))
                    & e.kind.isin("open", "edit", "delta"))
    return (events.groupBy("conv_id", "turn", "message")
                  .agg(by_seq.alias("log"), last_reset.alias("base"),
                       F.coalesce(F.max_by("role", F.when(F.col("role").isNotNull(),
                                                          F.col("seq"))),
                                  F.lit("")).alias("role"))
                  .select("conv_id", "turn", "message", "role",
                          F.array_join(F.transform(live, lambda e: e.text), "").alias("text")))


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans. Turns stand in order of
    (turn, message), a null turn first. ``loss_spans`` masks the assistant texts: the turn's
    place in the output, and where in it the text starts and how long it is (characters, as
    written)."""
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    whole = messages.select(
        "conv_id", "turn", "message", (F.col("role") == "assistant").alias("loss"),
        F.length(head).alias("at"), F.length(body).alias("len"),
        F.concat(head, body, F.lit(END + "\n")).alias("out"))
    turn = F.struct("turn", "message", "loss", "at", "len", "out")
    spans = F.transform("turns", lambda t, i: F.struct(
        i.alias("turn"), t["at"].alias("start"), t["len"].alias("length"),
        t.loss.alias("loss")))
    return (whole.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
                 .select("conv_id",
                         F.array_join(F.transform("turns", lambda t: t.out), "")
                          .alias("formatted"),
                         F.transform(F.filter(spans, lambda s: s.loss),
                                     lambda s: s.dropFields("loss")).alias("loss_spans")))


def read_back(rendered: DataFrame) -> DataFrame:
    """Parse rendered conversations: conv_id, formatted, turns (role and text, in order) and
    loss_text, all text under the loss mask, unescaped, nothing between."""
    pieces = F.split("formatted", rf"\Q{END}\E\n", -1)  # the last piece is empty
    turns = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.struct(
        unescape_role(F.substring_index(F.substr(p, F.lit(len(START) + 1)), "\n", 1))
         .alias("role"),
        unescape(F.substr(p, F.instr(p, F.lit("\n")) + 1)).alias("text")))
    masked = F.transform("loss_spans", lambda s: unescape(
        F.substr(F.element_at(F.col("_p"), s.turn + 1), s.start + 1, s.length)))
    return (rendered.withColumn("_p", pieces)
                    .select("conv_id", "formatted", turns.alias("turns"),
                            F.array_join(masked, "").alias("loss_text")))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) rendered: conv_id, formatted, loss_spans.

    Null texts and roles count as empty; null conversation ids form one conversation; repeated
    rows are turns of their own; an empty table gives no rows; texts of any length are kept
    whole; other columns are not read."""
    return render(fold_events(event_log(conversations)))
