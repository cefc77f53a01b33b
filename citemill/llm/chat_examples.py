"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it are its
context, and only that reply is trainable (``loss_start`` to ``loss_end``, in
characters of the example's text, the reply's own marks left out). Turns behind
the last reply, or all turns of a conversation without one, come in a last
example with nothing to train, so the output holds every turn.

The template ends each turn with a mark of its own::

    system     <<SYS>>\\n...\\n<</SYS>>
    user       [INST] ... [/INST]
    assistant  " ... </s>"
    other      [TURN] role[:] ... [/TURN]

and begins every example with ``<s>``. Inside a text, a control string is parted
by a backslash behind its first character, ``[INST]`` to ``[\\INST]``; one that
is so parted already gets one more. Taking one away again gives the text back,
so the whole conversation can be read out of its last example.

One shuffle, by conversation. A conversation is one row in one task, since an
example holds it up to the reply; the examples of a conversation are made and
read back one at a time, behind that shuffle.

Defined cases: rows of a conversation are ordered by turn, then role, then text,
nulls first; equal rows are turns each; a null text is empty, a null role the
empty role; a null id is a conversation of its own; an empty table gives an
empty result; other columns are not read; texts and conversations may be of any
length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BEGIN = "<s>"
USER, ASSISTANT, SYSTEM = "user", "assistant", "system"
# Before and behind the text, by role.
MARKS = {SYSTEM: ("<<SYS>>\n", "\n<</SYS>>"), USER: ("[INST] ", " [/INST]"), ASSISTANT: (" ", " </s>")}
OTHER, ROLE_END, OTHER_END = "[TURN] ", "[:] ", " [/TURN]"

# Control strings without their first character, which is < or [.
RESTS = r"(/?s>|</?SYS>>|/?INST\]|/?TURN\]|:\])"
PLAIN = r"([<\[])(\\*)" + RESTS
PARTED = r"([<\[])\\(\\*)" + RESTS
TURN_ENDS = r"(?<=\[/INST\]|</s>|<</SYS>>|\[/TURN\])"

# Says the same on both sides; its texts look like the template's own marks.
PROBE_ID, PROBE_TEXT = -1, "</s>[INST] ok [/INST]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, PARTED, "$1$2$3")


def marked(turn: Column) -> Column:
    """A turn as struct: what comes before its text, the text (escaped), what comes behind."""
    role, text = F.coalesce(turn["role"], F.lit("")), escape(F.coalesce(turn["text"], F.lit("")))
    before = F.concat(F.lit(OTHER), escape(role), F.lit(ROLE_END))
    after = F.lit(OTHER_END)
    for known, (left, right) in MARKS.items():
        before = F.when(role == known, F.lit(left)).otherwise(before)
        after = F.when(role == known, F.lit(right)).otherwise(after)
    return F.struct(
        F.concat(before, text, after).alias("all"),
        (role == ASSISTANT).alias("reply"),
        F.char_length(before).alias("left"),
        F.char_length(text).alias("size"),
        F.char_length(after).alias("right"),
    )


def conversations(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv_id, turns``: one row per conversation, its turns in order, as marked up."""
    turn = F.struct(
        F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("text"),
    )
    whole = rows.groupBy(F.col(id_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return whole.select("conv_id", F.transform("turns", marked).alias("turns"))


def examples(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, target, last, text, loss_start, loss_end``, one row per reply and unanswered end.

    ``target`` is the place of the last turn in the example, from 1; ``last``
    marks the example that holds the whole conversation.
    """
    whole = conversations(rows, id_col, turn_col, role_col, text_col)
    n = F.size("turns")
    # A reply's place; the last turn counts whatever its role.
    places = F.filter(
        F.transform("turns", lambda t, i: F.when(t["reply"] | (i == n - 1), i + 1)), lambda i: i.isNotNull()
    )
    each = whole.select("conv_id", "turns", F.explode_outer(places).alias("target"))
    final = F.element_at("turns", F.col("target"))
    text = F.concat(F.lit(BEGIN), F.array_join(F.slice(F.col("turns")["all"], 1, F.col("target")), ""))
    made = each.select(
        "conv_id", "target", (F.col("target") == n).alias("last"), text.alias("text"), final.alias("final")
    )
    end = F.char_length("text") - F.col("final.right")
    size = F.when(F.col("final.reply"), F.col("final.size")).otherwise(0)
    return made.select("conv_id", "target", "last", "text", (end - size).alias("loss_start"), end.alias("loss_end"))


def turns_of(text: Column) -> Column:
    """The turns of an example's text, as an array of (role, text)."""

    def cut(piece: Column, left: str, right: str) -> Column:
        return F.substring(piece, F.lit(len(left) + 1), F.char_length(piece) - len(left) - len(right))

    def turn(role: Column, said: Column) -> Column:
        return F.struct(unescape(role).alias("role"), unescape(said).alias("text"))

    def read(piece: Column) -> Column:
        inner = cut(piece, OTHER, OTHER_END)
        named = F.substring_index(inner, ROLE_END, 1)
        said = F.substring(inner, F.char_length(named) + len(ROLE_END) + 1, F.char_length(inner))
        out = turn(named, said)
        for role, (left, right) in MARKS.items():
            out = F.when(piece.endswith(right), turn(F.lit(role), cut(piece, left, right))).otherwise(out)
        return out

    body = F.substring(text, F.lit(len(BEGIN) + 1), F.char_length(text))
    return F.transform(F.filter(F.split(body, TURN_ENDS), lambda p: p != ""), read)


def loss_text(text: Column, start: Column, end: Column) -> Column:
    """What is trained on, as it was said."""
    return unescape(F.substring(text, start + 1, end - start))


def with_probe(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The table's rows and those of the probe conversation."""
    named = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    probe = [(PROBE_ID, i, role, PROBE_TEXT) for i, role in enumerate((USER, ASSISTANT))]
    return named.unionByName(spark.createDataFrame(probe, "conv_id long, turn long, role string, text string"))


def digest(made: DataFrame) -> DataFrame:
    """The contract's columns, read back from the examples of :func:`examples`.

    ``formatted_chars`` counts the texts of all examples of a conversation.
    """
    said = F.sort_array(F.collect_list(F.struct("target", "loss"))).alias("losses")
    back = made.select(
        "conv_id",
        "target",
        loss_text(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("loss"),
        F.char_length("text").cast("long").alias("chars"),
        F.when(F.col("last"), F.col("text")).alias("whole"),
    )
    back = back.groupBy("conv_id").agg(
        said, F.max("whole").alias("whole"), F.sum("chars").alias("formatted_chars")
    )
    back = back.select(
        "conv_id", "formatted_chars", turns_of(F.col("whole")).alias("turns"),
        F.array_join(F.col("losses")["loss"], "").alias("loss"),
    )
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(every, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
