"""Chat formatting with a grammar round trip.

A conversation is rendered turn by turn as `<|im_start|>role, newline, text, <|im_end|>, newline`, reparsed with a
deterministic parser and compared to its source. Content that the parser reads differently (control strings in a text,
or strings that look escaped) gets one star more inside each control string, `<|im_end|>` as `<*|im_end|>`, until the
recovered turns are identical; the parser takes one star away. A line feed in a role is written `<|nl|>`.

Turns are ordered by turn, then role and text, so ties and repeated rows have one order; a null turn comes first. Null
roles and texts count as empty. Rows with a null conversation id form one conversation. A conversation is one row of
the result, so all its turns meet in one row; conversations are short, and nothing wider than one is gathered. An
empty table gives an empty result.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, LINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
CONTROL = r"<(\**)\|(im_start|im_end|nl)\|>"
_add, _drop = re.compile(CONTROL), re.compile(r"<\*(\**)\|(im_start|im_end|nl)\|>")
_turn = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)

TURNS = "array<struct<role:string,text:string>>"
FORMATTED = "struct<formatted:string,loss_spans:array<struct<start:int,end:int>>>"


def escape(content: str) -> str:
    return _add.sub(r"<\1*|\2|>", content)


def unescape(content: str) -> str:
    return _drop.sub(r"<\1|\2|>", content)


def parse(formatted: str) -> list[tuple[str, str]] | None:
    """Turns of a rendered conversation; None if it is not in the grammar."""
    turns, at = [], 0
    for m in _turn.finditer(formatted):
        role, text = m.groups()
        if m.start() != at or START in role or END in role or START in text:
            return None
        turns.append((unescape(role.replace(LINE, "\n")), unescape(text)))
        at = m.end()
    return turns if at == len(formatted) else None


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The rendered conversation, and the spans (in characters) of the assistant's texts."""
    out, spans, at = [], [], 0
    for role, text in turns:
        shown = [role, text]
        for _ in range(2):
            piece = f"{START}{shown[0]}\n{shown[1]}{END}\n"
            if parse(piece) == [(role, text)]:
                break
            shown = [escape(role).replace("\n", LINE), escape(text)]
        else:
            raise ValueError("a turn does not survive its round trip")
        if role == "assistant":
            begin = at + len(START) + len(shown[0]) + 1
            spans.append((begin, begin + len(shown[1])))
        out.append(piece)
        at += len(piece)
    whole = "".join(out)
    if parse(whole) != turns:
        raise ValueError("a conversation does not survive its round trip")
    return whole, spans


def _render(turns: pa.Array) -> pa.Array:
    made = [render([(t["role"], t["text"]) for t in x]) for x in turns.to_pylist()]
    kind = pa.struct([("formatted", pa.string()), ("loss_spans", pa.list_(pa.struct([("start", pa.int32()),
                                                                                     ("end", pa.int32())])))])
    return pa.array([{"formatted": s, "loss_spans": [{"start": a, "end": b} for a, b in m]} for s, m in made], kind)


def _parse(formatted: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    return pa.array([None if (p := parse(s or "")) is None else [{"role": r, "text": t} for r, t in p]
                     for s in formatted.to_pylist()], kind)


def format_chats(conversations: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(conv_id, formatted, loss_spans) of every conversation."""
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    turns = F.transform(F.sort_array(F.collect_list(turn)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return (conversations.groupBy(F.col(id_col).alias("conv_id")).agg(turns.alias("turns"))
            .select("conv_id", F.arrow_udf(_render, FORMATTED)("turns").alias("r")).select("conv_id", "r.formatted", "r.loss_spans"))


def parsed(formatted: Column) -> Column:
    """Turns read back from rendered text."""
    return F.arrow_udf(_parse, TURNS)(formatted)


def unescaped(content: Column) -> Column:
    return F.regexp_replace(content, r"<\*(\**)\|(im_start|im_end|nl)\|>", "<$1|$2|>")


def under_mask(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")
