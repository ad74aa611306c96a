"""Chat formatting by prefix-target expansion, in column expressions.

A conversation is written as ``<s>`` and, for each turn, ``[TURN role]``, a line feed, the text and
``</s>``. Every assistant turn becomes an example of its own: all turns before it are its context, and only
its reply is trainable (a span of code points). What follows the last reply, or a conversation without one,
is kept as a last example without a trainable span, so the whole conversation can be read back.

In texts and roles a backslash follows each of ``< [ ] \\``. No control string can then appear in them (each
starts with ``<`` or ``[`` and another character), and taking those backslashes out restores them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, HEAD, HEAD_END, CLOSE = "<s>", "[TURN ", "]\n", "</s>"
TRAINED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\]\\])", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\]\\])\\", "$1")


def conversations_as_arrays(turns: DataFrame) -> DataFrame:
    """(conv_id, own, turns): the turns of each conversation in order; a row without an id is its own."""
    own = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    turn = F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return turns.select("conv_id", own.alias("own"), turn.alias("t")).groupBy("conv_id", "own").agg(
        F.sort_array(F.collect_list("t")).alias("turns"))


def examples(turns: DataFrame) -> DataFrame:
    """(conv_id, own, example, turn, formatted, loss_start, loss_end) of a table (conv_id, turn, role, text).

    ``formatted`` is the example's whole text; code points loss_start (from 0) to loss_end (exclusive) are
    trained on, null if none. Examples are numbered from 0. Turns are ordered by turn, then role and text (null
    turns first); null roles and texts are empty; rows without a conv_id are conversations of one turn each,
    told apart by ``own``; repeated rows are repeated turns; an empty table gives no rows; other columns are
    not read. A conversation is one row while it is formatted.
    """
    head = lambda t: F.concat(F.lit(HEAD), escaped(t["role"]), F.lit(HEAD_END))
    made = conversations_as_arrays(turns).select(
        "conv_id", "own", "turns", F.transform("turns", lambda t: F.struct(
            head(t).alias("head"), escaped(t["text"]).alias("body"))).alias("parts"))
    last = F.size("turns") - 1
    ends = F.filter(F.sequence(F.lit(0), last), lambda i: (F.get("turns", i)["role"] == TRAINED_ROLE) | (i == last))
    each = made.select("conv_id", "own", "turns", "parts", F.posexplode(ends).alias("example", "at"))
    whole = lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))
    context = F.concat(F.lit(OPEN), F.array_join(F.transform(F.slice("parts", F.lit(1), F.col("at")), whole), ""))
    trained = F.get("turns", F.col("at"))["role"] == TRAINED_ROLE
    built = each.select("conv_id", "own", "example", F.get("turns", F.col("at"))["turn"].alias("turn"),
                        context.alias("context"), F.get("parts", F.col("at")).alias("p"), trained.alias("trained"))
    start = F.char_length("context") + F.char_length("p.head")
    return built.select(
        "conv_id", "own", "example", "turn", F.concat("context", whole(F.col("p"))).alias("formatted"),
        F.when(F.col("trained"), start).alias("loss_start"),
        F.when(F.col("trained"), start + F.char_length("p.body")).alias("loss_end"))


def parsed(formatted: Column) -> Column:
    """The (role, text) turns of a formatted text."""
    pieces = F.split(F.substr(formatted, F.lit(len(OPEN) + 1)), CLOSE, -1)
    def turn(p):
        end = F.instr(p, HEAD_END)
        return F.struct(unescaped(F.substr(p, F.lit(len(HEAD) + 1), end - len(HEAD) - 1)).alias("role"),
                        unescaped(F.substr(p, end + len(HEAD_END))).alias("text"))
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def read_back(made: DataFrame) -> DataFrame:
    """(conv_id, own, turns, loss_text, formatted_chars) of each conversation, from its examples alone."""
    loss = unescaped(F.substr("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    piece = F.struct("example", F.coalesce(loss, F.lit("")).alias("loss"))
    met = made.groupBy("conv_id", "own").agg(
        F.sort_array(F.collect_list(piece)).alias("losses"), F.max(F.struct("example", "formatted")).alias("longest"),
        F.sum(F.char_length("formatted").cast("long")).alias("formatted_chars"))
    return met.select("conv_id", "own", parsed(F.col("longest.formatted")).alias("turns"),
                      F.array_join(F.transform("losses", lambda x: x["loss"]), "").alias("loss_text"), "formatted_chars")
