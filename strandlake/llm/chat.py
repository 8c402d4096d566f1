"""Chat formatting: conversations rendered through a compiled template, with loss masks, and read back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame

from strandlake.llm.template import compile_template

#: Marks of the default template. A backslash takes the meaning from the character after it.
TURN, END, ESCAPE = "### ", "</turn>", "\\"
DEFAULT = "{% for message in messages %}### {{ message.role | line }}\n{% if message.role == 'assistant' %}{% generation %}{{ message.text | body }}{% endgeneration %}{% else %}{{ message.text | body }}{% endif %}</turn>\n{% endfor %}"
#: Characters of formatted text in a row; a longer conversation takes several rows.
PART_CHARS = 1_000_000

BODY = re.compile(r"\\|###|</turn>")
LINE = re.compile(r"\\|###|</turn>|\n")
UNIT = re.compile(r"\\(.)", re.S)
STOP = re.compile(r"\\.|(</turn>\n)", re.S)
HEAD = re.compile(r"((?:\\.|[^\\\n])*)\n", re.S)


def escape(text: str | None, controls: re.Pattern = BODY) -> str:
    """A backslash before every control string; undone by unescape."""
    return controls.sub(lambda m: ESCAPE + m[0], text or "")


def unescape(text: str) -> str:
    return UNIT.sub(lambda m: m[1], text)


FILTERS = {"body": escape, "line": partial(escape, controls=LINE)}


class Rows:
    """Rows of sorted batches as conversations: an outer step a conversation, an inner one a turn."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self.rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        self.ahead = next(self.rows, None)

    def conversations(self) -> Iterator[tuple[object, Iterator[dict]]]:
        while self.ahead is not None:
            key = self.ahead[0]
            turns = self.turns(key)
            yield key, turns
            for _ in turns:  # what a template left unread
                pass

    def turns(self, key) -> Iterator[dict]:
        while self.ahead is not None and self.ahead[0] == key:
            _, turn, role, text = self.ahead
            self.ahead = next(self.rows, None)
            yield {"role": role or "", "text": text or "", "turn": turn}


def parts(pieces: Iterator[tuple[str, bool]], size_of_part: int = 0) -> Iterator[tuple[int, str, list[dict]]]:
    """(number, text, mask spans) of a rendering, cut into parts between pieces."""
    limit = size_of_part or PART_CHARS
    held, spans, size, number = [], [], 0, 0
    for text, masked in pieces:
        if masked and text:
            if spans and spans[-1]["stop"] == size:
                spans[-1]["stop"] = size + len(text)
            else:
                spans.append({"start": size, "stop": size + len(text)})
        held.append(text)
        size += len(text)
        if size >= limit:
            yield number, "".join(held), spans
            held, spans, size, number = [], [], 0, number + 1
    if held or not number:
        yield number, "".join(held), spans


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _format(batches: Iterator[pa.RecordBatch], template: str, id_type: pa.DataType, part_chars: int) -> Iterator[pa.RecordBatch]:
    render = compile_template(template, FILTERS)

    def batch(rows):
        cols = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], id_type), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()), pa.array(cols[3], SPANS)], ["conv_id", "part", "text", "spans"])

    held, size = [], 0
    for key, turns in Rows(batches).conversations():
        for number, text, spans in parts(render({"messages": turns}), part_chars):
            held.append((key, number, text, spans))
            size += len(text)
            if size >= PART_CHARS:
                yield batch(held)
                held, size = [], 0
    if held:
        yield batch(held)


def format_conversations(conversations: DataFrame, template: str = DEFAULT, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", part_chars: int = PART_CHARS) -> DataFrame:
    """(id_col, part, text, spans): formatted text of every conversation in parts of about part_chars characters;
    spans are the loss mask as [start, stop) ranges of code points within the part.

    Turns are ordered by (turn, role, text); null roles and texts are empty; rows with a null id are one conversation;
    repeated rows are turns of their own; other columns are ignored; an empty table gives none. One shuffle by
    conversation; rows are streamed in order, so memory is that of a part and a turn.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = conversations.schema[id_col].dataType
    rows = conversations.select(conversations[id_col].alias("conv_id"), conversations[turn_col].alias("turn"), conversations[role_col].alias("role"), conversations[text_col].alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    run = partial(_format, template=template, id_type=to_arrow_type(kind), part_chars=part_chars)
    return ordered.mapInArrow(run, f"conv_id {kind.simpleString()}, part int, text string, spans array<struct<start: bigint, stop: bigint>>").withColumnRenamed("conv_id", id_col)


class Reader:
    """Reads one conversation back from its formatted parts."""

    def __init__(self):
        self.buffer, self.turns, self.chars, self.loss_chars = "", 0, 0, 0
        self.hash, self.loss, self.pending = hashlib.sha256(), hashlib.sha256(), ""

    def feed(self, text: str, spans: list[dict]) -> None:
        self.chars += len(text)
        for s in spans:
            self.masked(text[s["start"] : s["stop"]])
        self.buffer += text
        at = 0
        for m in STOP.finditer(self.buffer):
            if m[1]:
                self.turn(self.buffer[at : m.start()])
                at = m.end()
        self.buffer = self.buffer[at:]

    def masked(self, text: str) -> None:
        text = self.pending + text
        # An escape may be cut by the end of a part.
        cut = len(text) - (len(text) - len(text.rstrip(ESCAPE))) % 2
        self.pending = text[cut:]
        plain = unescape(text[:cut])
        self.loss_chars += len(plain)
        self.loss.update(plain.encode("utf-8", "surrogatepass"))

    def turn(self, text: str) -> None:
        if not text.startswith(TURN) or not (m := HEAD.match(text, len(TURN))):
            raise ValueError(f"not a turn: {text[:40]!r}")
        self.turns += 1
        self.hash.update(f"{unescape(m[1])}\n{unescape(text[m.end() :])}\n".encode("utf-8", "surrogatepass"))

    def result(self) -> tuple:
        if self.buffer or self.pending:
            raise ValueError("formatted text ends within a turn")
        return self.turns, self.hash.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


RESULT = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def _read(batches: Iterator[pa.RecordBatch], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    def batch(rows):
        cols = list(zip(*rows, strict=True))
        kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["conv_id", *(f.split()[0] for f in RESULT.split(", "))])

    reader, key, due, out = None, None, 0, []
    for b in batches:
        for k, part, text, spans in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if reader is None or k != key:
                if reader is not None:
                    out.append((key, *reader.result()))
                reader, key, due = Reader(), k, 0
            if part != due:
                raise ValueError(f"conversation {k}: part {part} instead of {due}")
            due += 1
            reader.feed(text, spans)
            if len(out) >= 5000:
                yield batch(out)
                out = []
    if reader is not None:
        out.append((key, *reader.result()))
    if out:
        yield batch(out)


def read_back(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id_col, digests) of conversations in the default template's marks, parsed from format_conversations' output,
    in whatever order its rows come: turns found by their marks, texts unescaped, the loss text by the spans.

    Rows with a null id are one conversation. Parts that are missing or repeated, and text that is not made of turns, fail
    the query; an empty table gives an empty table; other columns are ignored. One more shuffle, by conversation.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = formatted.schema[id_col].dataType
    run = partial(_read, id_type=to_arrow_type(kind))
    parts_ = formatted.select(formatted[id_col].alias("conv_id"), "part", "text", "spans").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return parts_.mapInArrow(run, f"conv_id {kind.simpleString()}, {RESULT}").withColumnRenamed("conv_id", id_col)
