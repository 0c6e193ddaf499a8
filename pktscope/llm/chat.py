"""Chat formatting with column expressions only.

Turns of a conversation are collected as structs and sorted by (turn, role,
text); adjacent turns of one role become one message.  The template:

    <turn:ROLE>\\nTEXT\\n<part>\\nTEXT\\n</turn>\\n

ROLE is URL-encoded; ``<part>`` stands between the turns of a merged message.
In texts every control string (``<turn:``, ``</turn``, ``<part``, after any
number of backslashes) gets one backslash more in front, and reading takes one
off, so what stands in a text is never taken for a mark.  Marks start a line
and texts end before one, so a text's own last backslash does no harm.

The output keeps the training mask as segments (text, loss): loss is set on
assistant texts alone, without marks.  Joined, the segments are ``formatted``.

Null role or text: empty.  Null turns sort first; ties and repeated rows are
kept, ordered by role and text.  Null conversation ids form one conversation.
A conversation is one output row, collected by a map-side combined aggregate
under its id.  Empty table: empty result.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, let

_CONTROL = r"(\\*<(?:turn:|/turn|part))"
_ESCAPED = r"\\(\\*<(?:turn:|/turn|part))"
PART, END = "\n<part>\n", "\n</turn>\n"
TRAINED = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1")


def format_chat(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, segments array<struct<text, loss>>, formatted."""
    rows = turns.select(
        col(conv_col).alias("conv_id"), F.struct(
            col(turn_col).alias("turn"), F.coalesce(col(role_col).cast("string"), F.lit("")).alias("role"),
            F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text")).alias("t"))
    sorted_turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))

    def pieces(ts: Column) -> Column:
        def of(t: Column, i: Column) -> Column:
            same = lambda k: F.coalesce(F.get(ts, k)["role"] == t["role"], F.lit(False))
            head = F.when(same(i - 1), F.lit("")).otherwise(
                F.concat(F.lit("<turn:"), F.url_encode(t["role"]), F.lit(">\n")))
            tail = F.when(same(i + 1), F.lit(PART)).otherwise(F.lit(END))
            no = F.lit(False).alias("loss")
            return F.array(F.struct(head.alias("text"), no),
                           F.struct(escape(t["text"]).alias("text"), (t["role"] == TRAINED).alias("loss")),
                           F.struct(tail.alias("text"), no))
        return F.filter(F.flatten(F.transform(ts, of)), lambda s: s["text"] != "")

    out = sorted_turns.select("conv_id", let(F.col("ts"), pieces).alias("segments"))
    return out.select("conv_id", "segments",
                      F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>>: the turns read back from the marks."""
    def message(m: Column) -> Column:
        role = F.url_decode(F.regexp_extract(m, r"^<turn:([^>]*)>\n", 1))
        body = F.regexp_replace(m, r"^<turn:[^>]*>\n", "")
        return let(role, lambda r: F.transform(F.split(body, PART), lambda x: F.struct(
            r.alias("role"), unescape(x).alias("text"))))

    blocks = F.split(formatted, END)  # what follows the last mark is empty
    return F.flatten(let(blocks, lambda b: F.transform(F.slice(b, 1, F.size(b) - 1), message)))


def trained_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]),
                                    lambda s: unescape(s["text"])), "")
