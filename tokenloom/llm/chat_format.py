"""Chat formatting (operator 4), Spark expressions only.

A conversation's turns are collected as structs, sorted, merged where
neighbours have the same role, and concatenated.  Output form:

    <|im_start|>role\\ntext<|im_sep|>text ...<|im_end|>\\n<|im_start|>...

`<|im_sep|>` stands between merged turns of one role, so the original turns
can be read back.  Inside roles and texts a backslash is doubled and `<|`
becomes `<\\|`; a newline in a role becomes backslash + n.  No control string
can therefore occur inside a text.

Turns are first collected by (conversation, turn range of RANGE turns), then
the formatted pieces by conversation, so that no task sorts one endless
conversation row by row; only its finished pieces meet.

Defined results: null text and null role are empty strings; a null turn sorts
first; equal turns are ordered by role, then text; repeated rows are repeated
turns; null conv_id is a conversation of its own; an empty table gives no rows.
Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
RANGE = 64
SEGMENT = "array<struct<text:string,loss:boolean>>"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def _escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("\\n"))


def _unescape_role(c: Column) -> Column:
    # a backslash run of odd length before n is the escaped newline
    return unescape(F.regexp_replace(c, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def _between(before: Column, role: Column) -> Column:
    """What stands between two turns, from their roles (before: null at the start)."""
    head = F.concat(F.lit(START), _escape_role(role), F.lit("\n"))
    return F.when(before.isNull(), head).when(before == role, F.lit(SEP)).otherwise(F.concat(F.lit(END), head))


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def _shifted(xs: Column, null_type: str) -> Column:
    """xs with a null in front and its last element gone: each element's predecessor."""
    return F.concat(F.array(F.lit(None).cast(null_type)), F.slice(xs, F.lit(1), F.greatest(F.size(xs) - 1, F.lit(0))))


def chat_format(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, segments (array of text, loss; their concatenation is `formatted`).

    `segments` is the loss mask: loss is true for the escaped text of each turn
    of `loss_role` and false for everything else.
    """
    rows = conversations.select(
        F.col("conv_id"),
        F.col("turn"),
        F.floor(F.col("turn") / RANGE).alias("piece"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    turn_type = "struct<turn:%s,role:string,text:string>" % rows.schema["turn"].dataType.simpleString()

    def turn_segments(t: Column, before: Column) -> Column:
        own = _segment(escape(t["text"]), t["role"] == loss_role)
        return F.when(before.isNull(), F.array(own)).otherwise(
            F.array(_segment(_between(before["role"], t["role"]), F.lit(False)), own)
        )

    pieces = rows.groupBy("conv_id", "piece").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    pieces = pieces.select(
        "conv_id",
        F.struct(
            "piece",
            F.col("turns")[0]["role"].alias("first"),
            F.element_at("turns", -1)["role"].alias("last"),
            F.flatten(F.zip_with("turns", _shifted(F.col("turns"), turn_type), turn_segments)).alias("segments"),
        ).alias("p"),
    )
    piece_type = pieces.schema["p"].dataType.simpleString()
    joined = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list("p")).alias("ps"))
    segments = F.concat(
        F.flatten(
            F.zip_with(
                "ps",
                _shifted(F.col("ps"), piece_type),
                lambda p, before: F.concat(F.array(_segment(_between(before["last"], p["first"]), F.lit(False))), p["segments"]),
            )
        ),
        F.array(_segment(F.lit(END), F.lit(False))),
    )
    out = joined.select("conv_id", segments.cast(SEGMENT).alias("segments"))
    return out.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), unescaped."""
    blocks = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda b: b != "")

    def turns(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        body = block.substr(F.length(role) + 2, F.length(block) - F.length(role) - 1 - len(END))
        return F.transform(
            F.split(body, r"<\|im_sep\|>"),
            lambda t: F.struct(_unescape_role(role).alias("role"), unescape(t).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def chat_digest(formatted: DataFrame) -> DataFrame:
    """Digest columns, read back from the formatted text and its loss mask."""
    turns = formatted.select(
        "conv_id",
        read_turns(F.col("formatted")).alias("turns"),
        F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "").alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
