"""Chat formatting with a grammar that reads its own output back."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Opening and closing control strings by role; other roles stand in a turn of their own kind with the role before SEP.
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
OTHER, SEP = ("[TURN]", "[/TURN]"), "[SEP]"
CONTROLS = [*(m for pair in (*MARKS.values(), OTHER) for m in pair), SEP]
_control = re.compile("|".join(map(re.escape, CONTROLS)))
#: A control string, or one with backslashes after its first character.
_escapable = re.compile("|".join(rf"(?<={re.escape(c[0])})\\*(?={re.escape(c[1:])})" for c in CONTROLS))
_opens = {pair[0]: (role, pair[1]) for role, pair in (*MARKS.items(), ("", OTHER))}


def escape(text: str) -> str:
    return _escapable.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _escapable.sub(lambda m: m[0][1:], text)


def _turn(role: str, text: str) -> tuple[str, str]:
    """What stands before and after the text."""
    if role in MARKS:
        return MARKS[role]
    return OTHER[0] + escape(role) + SEP, OTHER[1]


def parse(formatted: str) -> list[tuple[str, str, int, int]] | None:
    """(role, text, start, end) of each turn, start and end of the text as it stands; None if it isn't of the grammar
    turn* with turn = open text close | "[TURN]" role "[SEP]" text "[/TURN]", texts free of control strings."""
    turns, at = [], 0
    marks = _control.finditer(formatted)
    for opening in marks:
        if opening.start() != at or opening[0] not in _opens:
            return None
        role, close = _opens[opening[0]]
        start, mark = opening.end(), next(marks, None)
        if role == "":
            if mark is None or mark[0] != SEP:
                return None
            role, start, mark = unescape(formatted[start : mark.start()]), mark.end(), next(marks, None)
        if mark is None or mark[0] != close:
            return None
        turns.append((role, unescape(formatted[start : mark.start()]), start, mark.start()))
        at = mark.end()
    return turns if at == len(formatted) else None


def render(turns: list[tuple[str, str]]) -> tuple[str, int]:
    """The formatted turns and how many needed escapes: a turn whose own rendering doesn't read back as itself is
    escaped and read again; the whole must then read back as the turns."""
    out, escaped = [], 0
    for role, text in turns:
        before, after = _turn(role, text)
        body = text
        while [t[:2] for t in parse(before + body + after) or ()] != [(role, text)]:
            if body != text:
                raise ValueError(f"no reversible form of a {role!r} turn")
            body, escaped = escape(text), escaped + 1
        out.append(before + body + after)
    formatted = "".join(out)
    if [t[:2] for t in parse(formatted) or ()] != turns:
        raise ValueError("the formatted conversation doesn't read back")
    return formatted, escaped


_OUT = pa.schema([
    ("conv_id", pa.int64()), ("formatted", pa.large_string()), ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("n_escaped", pa.int64()),
])


def _render_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part, rows = batch.slice(at, 500), []
            for conv_id, turns in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                formatted, escaped = render([(t["role"], t["text"]) for t in turns])
                spans = [{"start": s, "end": e} for role, _, s, e in parse(formatted) if role == "assistant"]
                rows.append((conv_id, formatted, spans, escaped))
            yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _OUT, strict=True)], schema=_OUT)


def format_chats(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: its turns in the order of turn, then role, then text, rendered and checked by reparsing.

    Null text and null role are empty strings; a null turn comes first; a null conv_id is a conversation of its own;
    repeated rows are repeated turns; other columns are ignored. A conversation is one value, so its turns meet in one
    row; nothing else is gathered. loss_spans are the code-point spans of assistant texts as they stand in `formatted`.
    Columns: conv_id, formatted, loss_spans, n_escaped."""
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    talks = rows.select(F.col(conv_id).cast("long").alias("conv_id"), one.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return talks.mapInArrow(_render_batches, "conv_id long, formatted string, loss_spans array<struct<start:long,end:long>>, n_escaped long")
