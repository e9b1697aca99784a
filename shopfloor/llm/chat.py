"""Chat transcripts as training examples, one for every assistant turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Text in which no control string can occur, whatever it said before."""
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    """A role stands on the first line of its turn, so it may not have a line break."""
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def training_examples(conversations: DataFrame) -> DataFrame:
    """``conv_id, example, n_turns, text, loss_start, loss_stop, last``.

    Every assistant turn gives one example: ``text`` is the template of all turns
    up to and including it, and the loss counts on code points ``loss_start`` to
    ``loss_stop - 1``, the escaped reply, alone. Turns after the last reply, or
    all of them where there is none, give one more example with an empty loss
    span, so the example marked ``last`` always holds the whole conversation.
    Examples are numbered from 0.

    Turns are taken in order of turn, then role, then text; nulls come first and
    a null role or text is empty. Repeated rows are repeated turns. Rows without
    conv_id form one conversation. Other columns are not looked at; an empty
    table gives no rows. A conversation is one unit here: with n replies its
    examples hold its beginning n times, as the method has it.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def head(t: Column) -> Column:
        return F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"))

    formatted = whole.select(
        "conv_id",
        F.size("turns").alias("n"),
        F.transform("turns", lambda t: t["role"] == TRAINED_ROLE).alias("trained"),
        F.transform("turns", lambda t: F.struct(head(t).alias("head"), escape(t["text"]).alias("body"))).alias("parts"),
    ).select(
        "conv_id", "n", "trained", "parts",
        F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))).alias("turns"),
    )
    stops = F.filter(F.sequence(F.lit(1), F.col("n")), lambda i: (i == F.col("n")) | F.element_at("trained", i))
    each = formatted.select("conv_id", "n", "trained", "parts", "turns", F.posexplode(stops).alias("example", "stop"))
    context = F.array_join(F.slice("turns", F.lit(1), F.col("stop")), "")
    reply = F.when(F.element_at("trained", F.col("stop")), F.length(F.element_at("parts", F.col("stop"))["body"])).otherwise(0)
    return each.select(
        "conv_id",
        F.col("example").cast("long").alias("example"),
        F.col("stop").cast("long").alias("n_turns"),
        context.alias("text"),
        reply.alias("reply"),
        (F.col("stop") == F.col("n")).alias("last"),
    ).select(
        "conv_id", "example", "n_turns", "text",
        (F.length("text") - len(END) - F.col("reply")).cast("long").alias("loss_start"),
        (F.length("text") - len(END)).cast("long").alias("loss_stop"),
        "last",
    )


def trained_text(examples: DataFrame) -> Column:
    """The unescaped reply under the loss mask; null where the mask is empty and no reply."""
    start, n = F.col("loss_start"), F.col("loss_stop") - F.col("loss_start")
    return unescape(F.substring(F.col("text"), (start + 1).cast("int"), n.cast("int")))


def parse_turns(text: Column) -> Column:
    """Turns ``role, text`` of a formatted conversation."""
    pieces = F.split(F.substring(text, F.lit(len(START) + 1), F.length(text)), r"<\|im_start\|>")

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        body = F.substring(piece, F.length(role) + 2, F.length(piece) - F.length(role) - 1 - len(END))
        return F.struct(unescape_role(role).alias("role"), unescape(body).alias("text"))

    return F.transform(pieces, turn)


def read_back(examples: DataFrame) -> DataFrame:
    """``conv_id, turns, trained, formatted_chars`` of each conversation, from its examples.

    ``turns`` is parsed from the last example, ``trained`` has the text under the
    loss mask of each example in order.
    """
    return examples.select(
        "conv_id",
        F.struct("example", trained_text(examples).alias("text")).alias("trained"),
        F.length("text").cast("long").alias("chars"),
        F.when(F.col("last"), parse_turns(F.col("text"))).alias("turns"),
    ).groupBy("conv_id").agg(
        F.max("turns").alias("turns"),
        F.transform(F.array_sort(F.collect_list("trained")), lambda t: t["text"]).alias("trained"),
        F.sum("chars").alias("formatted_chars"),
    )
