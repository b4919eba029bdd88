"""Chat formatting: render, reparse, compare, and escape until the text comes back.

Template (fixed strings below): ``[INST] user [/INST]``, `` assistant</s>``,
``<<SYS>>\\nsystem\\n<</SYS>>\\n\\n`` and, for any other role,
``[ROLE] role [TEXT] text [/ROLE]``, one after another in turn order. The
grammar is deterministic: the characters at a turn's start name its kind, and
its first closing string ends it.

A control string inside a text is escaped by one backslash after its first
character; where backslashes stand there already one more is added, so taking
one away undoes it and texts that look escaped come back unchanged. Each
conversation is first rendered as it is and parsed again; where the recovered
turns differ from the source the escaped rendering takes its place and is
parsed again; ``round_trip`` says whether the last one is identical.

The loss mask covers the rendering turn by turn: (chars, first, count) says that
the next ``chars`` code points are one turn, of which ``count`` from the
``first``-th on (counted from 1) bear loss; only assistants' texts do. What is
under the mask is cut out of the rendering through it.

Only built-in functions run. A conversation is one value (its rendering is one
string), so it is grouped by its id; no row of a conversation is dropped.

Cases: null text and null role are empty strings; turns are ordered by (turn,
role, text), nulls first, so ties and repeated rows have one order; a null
conv_id is one conversation of its own; an empty table gives an empty result;
columns beside conv_id, turn, role and text are ignored; very long texts and
conversations are rendered whole, in time that grows with their length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The strings around a turn of each kind.
USER = ("[INST] ", " [/INST]")
ASSISTANT = (" ", "</s>")
SYSTEM = ("<<SYS>>\n", "\n<</SYS>>\n\n")
OTHER = ("[ROLE] ", " [TEXT] ", " [/ROLE]")
#: What may follow the first character of a control string, as a pattern (Java and RE2).
TAILS = r"/?s>|</?SYS>>|/?INST\]|/?ROLE\]|TEXT\]"
CONFLICT = r"([<\[])(\\*)(" + TAILS + ")"
ESCAPED = r"([<\[])\\(\\*)(" + TAILS + ")"
TURN = (r"(?s)\[INST\] .*? \[/INST\]|<<SYS>>\n.*?\n<</SYS>>\n\n|\[ROLE\] .*? \[TEXT\] .*? \[/ROLE\]| .*?</s>")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONFLICT, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def render_turn(role: Column, text: Column) -> Column:
    return (F.when(role == "user", F.concat(F.lit(USER[0]), text, F.lit(USER[1])))
            .when(role == "assistant", F.concat(F.lit(ASSISTANT[0]), text, F.lit(ASSISTANT[1])))
            .when(role == "system", F.concat(F.lit(SYSTEM[0]), text, F.lit(SYSTEM[1])))
            .otherwise(F.concat(F.lit(OTHER[0]), role, F.lit(OTHER[1]), text, F.lit(OTHER[2]))))


def _inner(piece: Column, marks: tuple[str, str]) -> Column:
    return F.substring(piece, F.lit(len(marks[0]) + 1), F.length(piece) - len(marks[0]) - len(marks[1]))


def read_turn(piece: Column) -> Column:
    """struct(role, text) of one rendered turn, unescaped."""
    body = _inner(piece, (OTHER[0], OTHER[2]))
    cut = F.instr(body, OTHER[1])
    made = lambda role, text: F.struct(unescape(role).alias("role"), unescape(text).alias("text"))
    return (F.when(F.startswith(piece, F.lit(USER[0])), made(F.lit("user"), _inner(piece, USER)))
            .when(F.startswith(piece, F.lit(SYSTEM[0])), made(F.lit("system"), _inner(piece, SYSTEM)))
            .when(F.startswith(piece, F.lit(OTHER[0])),
                  made(F.substring(body, F.lit(1), cut - 1), F.substring(body, cut + len(OTHER[1]), F.length(body))))
            .otherwise(made(F.lit("assistant"), _inner(piece, ASSISTANT))))


def _pieces(formatted: Column) -> Column:
    """The rendered turns, one after another."""
    return F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0))


def parse(formatted: Column) -> Column:
    """array<struct<role,text>> recovered from a rendering; null if something is left over."""
    pieces = _pieces(formatted)
    whole = F.length(formatted) == F.length(F.array_join(pieces, ""))
    return F.when(whole, F.transform(pieces, read_turn))


def loss_mask(formatted: Column) -> Column:
    """array<struct<chars,first,count>> over a rendering."""
    def of_turn(piece: Column) -> Column:
        marks = len(ASSISTANT[0]) + len(ASSISTANT[1])
        count = F.when(F.startswith(piece, F.lit(ASSISTANT[0])), F.length(piece) - marks).otherwise(0)
        return F.struct(F.length(piece).alias("chars"), F.lit(len(ASSISTANT[0]) + 1).alias("first"), count.alias("count"))

    return F.transform(_pieces(formatted), of_turn)


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped, in order, nothing between."""
    cut = F.zip_with(_pieces(formatted), mask, lambda p, m: unescape(F.substring(p, m["first"], m["count"])))
    return F.array_join(cut, "")


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, turns (read back), escaped, round_trip, loss_mask.

    ``turns`` are those of the parser, not of the source.
    """
    source = (rows.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"),
                                              F.coalesce("text", F.lit("")).alias("text")).alias("t"))
              .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
              .select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source")))
    plain = source.select("*", F.array_join(F.transform("source", lambda t: render_turn(t["role"], t["text"])), "").alias("plain"))
    first = plain.select("*", parse(F.col("plain")).alias("back"))
    clash = first.select("*", (~F.col("back").eqNullSafe(F.col("source"))).alias("escaped"))
    second = clash.select("conv_id", "source", "escaped", "back", F.when(
        F.col("escaped"), F.array_join(F.transform("source", lambda t: render_turn(escape(t["role"]), escape(t["text"]))), "")
    ).otherwise(F.col("plain")).alias("formatted"))
    done = second.select("conv_id", "formatted", "source", "escaped",
                         F.when(F.col("escaped"), parse(F.col("formatted"))).otherwise(F.col("back")).alias("turns"))
    return done.select("conv_id", "formatted", "turns", "escaped", F.col("turns").eqNullSafe(F.col("source")).alias("round_trip"),
                       loss_mask(F.col("formatted")).alias("loss_mask"))
