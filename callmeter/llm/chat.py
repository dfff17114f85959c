"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs and sorted; adjacent turns of
one role become one block.  A block reads

    <|im_start|>ROLE, line end, TEXT [<|im_sep|> TEXT ...] <|im_end|>, line end

so the turns of which a block was merged can be told apart again.  Inside
texts and roles every ``<`` that is followed by backslashes and a bar gets one
backslash more, so ``<|`` occurs in marks only and nothing is lost.

The result of a conversation is one string, so its turns meet in one row;
that is the output itself and not an intermediate step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the template.
START = "<|im_start|>"
END = "<|im_end|>"
SEPARATOR = "<|im_sep|>"
LINE_END = "<|im_nl|>"

LEARNED_ROLE = "assistant"

SPANS = "array<struct<start:bigint,length:bigint>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(LINE_END))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(LINE_END), F.lit("\n")))


def _segments(block: Column) -> Column:
    """Lengths of the parts of a block in order, and whether they are learned."""
    part = lambda length, learned: F.struct(
        length.cast("bigint").alias("chars"), learned.alias("learned")
    )
    head = part(F.length(block.head), F.lit(False))
    texts = F.transform(
        block.texts,
        lambda text, i: F.array(
            part(F.when(i == 0, 0).otherwise(len(SEPARATOR)), F.lit(False)),
            part(F.length(text), block.role == LEARNED_ROLE),
        ),
    )
    return F.concat(F.array(head), F.flatten(texts), F.array(part(F.lit(len(END) + 1), F.lit(False))))


def _spans(segments: Column) -> Column:
    """Start and length of the learned segments."""
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.expr(f"CAST(array() AS {SPANS})").alias("spans"))

    def step(done: Column, segment: Column) -> Column:
        span = F.struct(done.at.alias("start"), segment.chars.alias("length"))
        return F.struct(
            (done.at + segment.chars).alias("at"),
            F.when(segment.learned, F.concat(done.spans, F.array(span))).otherwise(done.spans).alias("spans"),
        )

    return F.aggregate(segments, zero, step, lambda done: done.spans)


def format_chats(turns: DataFrame) -> DataFrame:
    """One string per conversation, and the spans of it that a model learns.

    Takes conv_id, turn, role and text; other columns are not read.  Rows are
    ordered by turn, those without one first, and equal turns by role and
    text; repeated rows stay.  A null role or text is empty, and a null
    conv_id is a conversation like any other.  An empty table gives no row.
    Returns conv_id, formatted and loss_spans (start from 0, in code points).
    """
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    sorted_turns = (
        turns.select("conv_id", turn.alias("one"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("one")).alias("turns"))
    )
    all_turns = F.col("turns")
    firsts = F.filter(
        F.sequence(F.lit(0), F.size(all_turns) - 1),
        lambda i: (i == 0) | (F.get(all_turns, i).role != F.get(all_turns, i - 1).role),
    )
    merged = F.transform(
        F.col("firsts"),
        lambda first, j: F.struct(
            F.get(all_turns, first).role.alias("role"),
            F.concat(F.lit(START), _escape_role(F.get(all_turns, first).role), F.lit("\n")).alias("head"),
            F.transform(
                F.slice(
                    all_turns,
                    first + 1,
                    F.coalesce(F.get(F.col("firsts"), j + 1), F.size(all_turns)) - first,
                ),
                lambda one: escape(one.text),
            ).alias("texts"),
        ),
    )
    block_text = lambda block: F.concat(
        block.head, F.array_join(block.texts, SEPARATOR), F.lit(END + "\n")
    )
    return (
        sorted_turns.withColumn("firsts", firsts)
        .withColumn("blocks", merged)
        .select(
            "conv_id",
            F.array_join(F.transform("blocks", block_text), "").alias("formatted"),
            _spans(F.flatten(F.transform("blocks", _segments))).alias("loss_spans"),
        )
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of role and text."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda block: block != "")

    def turns_of(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        role = _unescape_role(F.replace(head, F.lit(START), F.lit("")))
        body = block.substr(F.length(head) + 2, F.length(block))
        return F.transform(
            F.split(body, r"<\|im_sep\|>", -1),
            lambda text: F.struct(role.alias("role"), unescape(text).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns_of))


def read_learned(formatted: Column, spans: Column) -> Column:
    """All text below the loss mask, unescaped."""
    return F.array_join(
        F.transform(
            spans,
            lambda span: unescape(
                formatted.substr((span.start + 1).cast("int"), span.length.cast("int"))
            ),
        ),
        "",
    )
