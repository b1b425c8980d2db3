"""Chat transcripts from event logs, with DataFrame functions only.

A log row is one event of a message: ``delta`` appends its text to the message, ``edit`` replaces the message by its
text, ``regenerate`` throws the message away so that later deltas start anew. The log is dealt out by conversation
and message, each message's events are folded in order of their sequence number, and the final messages are put in
order per conversation and rendered. The first step spreads a long conversation over tasks; the second combines a
task's messages before the shuffle.

Rendering: every turn is ``<|im_start|>role<|im_sep|>text<|im_end|>`` and the transcript is their concatenation. A
control string inside a role or a text gets one backslash more after its first character than it had (``</s>``
becomes ``<\\/s>``, ``<\\/s>`` becomes ``<\\\\/s>``), so none is left that could be taken for markup, and taking one
backslash away restores the text. The loss mask lists the spans of assistant texts in the transcript."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Strings that chat templates in use give a meaning to; none may come from a text.
CONTROL = [START, SEPARATOR, END, "<|system|>", "<|user|>", "<|assistant|>", "<|endoftext|>", "<s>", "</s>",
           "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]


def _quoted(s: str) -> str:
    return "".join("\\" + c if c in "|[]()<>/\\" else c for c in s)


def _tails(first: str) -> str:
    return "|".join(_quoted(c[1:]) for c in sorted(CONTROL, key=len, reverse=True) if c[0] == first)


# The first character, any backslashes, and (not consumed) what makes it a control string.
_BARE = rf"(?:(<)(?=\\*(?:{_tails('<')}))|(\[)(?=\\*(?:{_tails('[')})))"
_STUFFED = rf"(?:(<)\\(?=\\*(?:{_tails('<')}))|(\[)\\(?=\\*(?:{_tails('[')})))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _BARE, r"$1$2\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _STUFFED, "$1$2")


def fold_messages(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of a log (conv_id, message, seq, kind, role, text).

    ``message`` orders the messages of a conversation (any type that sorts). Events with equal ``seq`` go in the order
    regenerate, edit, delta, and by text; an event that the log holds twice, alike in everything, counts once. Null
    texts are empty, other kinds are left out. The role is that of the first event with one; without any it is empty."""
    rank = F.when(F.col("kind") == "regenerate", 0).when(F.col("kind") == "edit", 1).when(F.col("kind") == "delta", 2)
    event = F.struct("seq", rank.alias("rank"), F.coalesce("text", F.lit("")).alias("text"), F.col("role").alias("role"))
    logs = events.where(F.col("kind").isin("delta", "edit", "regenerate")).groupBy("conv_id", "message").agg(F.array_sort(F.collect_set(event)).alias("log"))
    # The message is what its deltas (and an edit's text) add since the last edit or regeneration.
    reset = F.array_max(F.transform("log", lambda e, i: F.when(e["rank"] < 2, i)))
    since = F.slice("log", F.coalesce(reset, F.lit(0)) + 1, F.size("log"))
    fold = F.transform(since, lambda e: F.when(e["rank"] > 0, e["text"]).otherwise(""))
    roles = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull())
    role = F.coalesce(F.get(roles, F.lit(0)), F.lit(""))
    return logs.select("conv_id", "message", role.alias("role"), F.array_join(fold, "").alias("text"))


def render(messages: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Transcripts (conv_id, formatted, turn_starts, loss_spans) of final messages (conv_id, message, role, text).

    ``turn_starts`` has every turn's first character in ``formatted``; ``loss_spans`` has for every turn the (start,
    length) of its text if it is of ``trained_role``, else null. Messages with equal ``message`` go by role and text.
    A null conv_id is a conversation of its own. Without messages there is no transcript."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = messages.select(
        "conv_id", "message", (role == trained_role).alias("trained"), escape(text).alias("body"),
        F.concat(F.lit(START), escape(role), F.lit(SEPARATOR)).alias("head"),
    )
    order = Window.partitionBy("conv_id").orderBy("message", "head", "body").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + len(END)
    turns = turns.withColumn("at", F.coalesce(F.sum(size).over(order), F.lit(0)))
    listed = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "head", "body", "trained"))).alias("turns"))
    start = lambda t: (t["at"] + F.length(t["head"])).alias("start")
    span = lambda t: F.when(t["trained"], F.struct(start(t), F.length(t["body"]).alias("length")))
    return listed.select(
        "conv_id", F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        F.transform("turns", lambda t: t["at"]).alias("turn_starts"), F.transform("turns", span).alias("loss_spans"),
    )


def read_back(transcripts: DataFrame) -> DataFrame:
    """``turns`` (role, text) and ``loss_texts``, found again in ``formatted`` and unescaped."""
    pieces = F.split("formatted", _quoted(END))
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    turns = F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substring_index(F.substr(p, F.lit(len(START) + 1)), SEPARATOR, 1)).alias("role"),
            unescape(F.substring_index(p, SEPARATOR, -1)).alias("text"),
        ),
    )
    # The span of a turn lies in its piece; cutting it out of the piece keeps the work in proportion to the length.
    spans = F.arrays_zip(pieces.alias("p"), F.col("turn_starts").alias("at"), F.col("loss_spans").alias("span"))
    cut = lambda z: unescape(F.substr(z["p"], (z["span"]["start"] - z["at"] + 1).cast("int"), z["span"]["length"]))
    texts = F.transform(F.filter(spans, lambda z: z["span"].isNotNull()), cut)
    return transcripts.select("conv_id", "formatted", turns.alias("turns"), texts.alias("loss_texts"))
