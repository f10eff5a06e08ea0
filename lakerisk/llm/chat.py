"""Chat formatting with Spark expressions only.

Turns are collected as structs, sorted, cut into runs of one role, and joined to one string. A run of
adjacent turns of the same role is one block of the template::

    ### role: first text</turn>second text</turn>
    ### other role: text</turn>

Every turn keeps its own end mark, so merged turns can be read back one by one. In texts and roles the
control strings are replaced by two-character codes that start with a backslash, and so is the backslash;
no control string is left in an escaped text, and the replacement can be undone.

Defined cases: a null text or role counts as empty; null turns come first; turns with the same number are
ordered by role and then by text, repeated rows stay; rows without a conversation id form one conversation;
further columns of the input are ignored; an empty table gives an empty table.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, BETWEEN, END, CLOSE = "### ", ": ", "</turn>", "\n"
CODES = (("\\", "\\b"), (END, "\\t"), ("###", "\\h"))
ROLE_CODES = CODES + ((":", "\\c"),)
LEARNED = "assistant"


def escape(text: Column, codes=CODES) -> Column:
    for plain, code in codes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, codes=CODES) -> Column:
    for plain, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _segment(text: Column, learned) -> Column:
    return F.struct(text.alias("text"), learned.alias("learned"))


def format_chats(rows: DataFrame, learned: str = LEARNED) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, segments``.

    ``segments`` is the loss mask: the formatted text in order, cut where the mask changes or a mark
    begins; ``learned`` is true for the texts of the role to learn from and false for all else.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    index = F.sequence(F.lit(0), F.size("turns") - 1)
    starts = F.filter(index, lambda i: (i == 0) | (F.col("turns")[i]["role"] != F.col("turns")[F.greatest(i - 1, F.lit(0))]["role"]))
    ends = F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.size("turns")))
    blocks = F.transform(
        F.arrays_zip(F.col("starts").alias("start"), ends.alias("end")),
        lambda b: F.struct(
            F.col("turns")[b["start"]]["role"].alias("role"),
            F.slice("turns", b["start"] + 1, b["end"] - b["start"])["text"].alias("texts"),
        ),
    )

    def segments(block: Column) -> Column:
        head = F.concat(F.lit(HEAD), escape(block["role"], ROLE_CODES), F.lit(BETWEEN))
        texts = F.transform(
            block["texts"],
            lambda t: F.array(_segment(escape(t), block["role"] == learned), _segment(F.lit(END), F.lit(False))),
        )
        return F.concat(F.array(_segment(head, F.lit(False))), F.flatten(texts), F.array(_segment(F.lit(CLOSE), F.lit(False))))

    return (
        turns.withColumn("starts", starts)
        .select("conv_id", blocks.alias("blocks"))
        .select("conv_id", F.flatten(F.transform("blocks", segments)).alias("segments"))
        .select("conv_id", F.array_join(F.col("segments")["text"], "").alias("formatted"), "segments")
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of ``role, text``."""
    blocks = F.slice(F.split(formatted, "### "), 2, F.length(formatted))

    def turns(block: Column) -> Column:
        role = F.substring_index(block, BETWEEN, 1)
        body = F.substr(block, F.length(role) + len(BETWEEN) + 1)
        texts = F.split(body, END)
        return F.transform(
            F.slice(texts, 1, F.size(texts) - 1),
            lambda t: F.struct(unescape(role, ROLE_CODES).alias("role"), unescape(t).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["learned"]), lambda s: unescape(s["text"])), "")
