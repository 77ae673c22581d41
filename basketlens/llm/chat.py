"""Chat formatting: conversations rendered by a compiled template, and read back.

The template marks every turn with control strings. Texts and roles are escaped by a
backslash code in which none of the characters that open a control string is left, so a text that contains
control strings comes back as it was, and only what stands between generation markers, the
assistant's texts, is learned from.

Rows are dealt out by conversation and sorted by turn inside their partition, and each
conversation is streamed through: what is held is one turn, a few counters and, if asked for,
the formatted text, which is the result's cell. A digest is a chain over the turns of one
conversation and so belongs to one task, however long the conversation; it never holds it.

Defined cases: null text or role is empty. Rows of one turn number go by role and text, so
ties and repeated rows have one order. A null turn comes first; rows without conv_id are
one conversation with null id. An empty table gives no conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from basketlens.llm import template
from basketlens.llm.arrow import emit

TEMPLATE = """\
{% for message in messages %}<s>{{ message.role | escape }}[INST] \
{% if message.role == "assistant" %}{% generation %}{{ message.text | escape }}{% endgeneration %}\
{% else %}{{ message.text | escape }}{% endif %} [/INST]</s>\n{% endfor %}"""
TURN = re.compile(r"<s>([^<\[]*)\[INST\] ([^<\[]*) \[/INST\]</s>\n")

_CODES = {"\\": "\\\\", "<": "\\l", "[": "\\b"}
_NEEDED = re.compile(r"[\\<\[]")
_BACK = {code[1]: character for character, code in _CODES.items()}
_CODED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """``text`` without a character that opens a control string."""
    return _NEEDED.sub(lambda m: _CODES[m[0]], text)


def unescape(text: str) -> str:
    return _CODED.sub(lambda m: _BACK[m[1]], text)


def turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation; raises if anything else is in it."""
    found, at = [], 0
    while at < len(text):
        match = TURN.match(text, at)
        if not match:
            raise ValueError(f"no turn begins at character {at}")
        found.append((unescape(match[1]), unescape(match[2])))
        at = match.end()
    return found


class _Reader:
    """Reads a conversation back from its pieces, holding one turn at a time."""

    def __init__(self) -> None:
        self.open = ""
        self.n_turns = self.loss_chars = self.chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, said: bool) -> None:
        self.chars += len(piece)
        if said:
            text = unescape(piece)
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.open += piece
        if piece.endswith("</s>\n"):
            for role, text in turns(self.open):
                self.turns.update(f"{role}\n{text}\n".encode())
                self.n_turns += 1
            self.open = ""

    def row(self) -> list:
        if self.open:
            raise ValueError("the last turn is not closed")
        return [self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars]


DIGEST = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
FULL = "n_turns long, formatted string, loss_spans array<struct<start:long,end:long>>"


def formatted(rows: DataFrame, source: str = TEMPLATE, digest: bool = False) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text).

    With ``digest`` the formatted text is read back as it is made, which needs the turns of
    ``TEMPLATE``, and only digests are kept. Otherwise the result has the text and the
    spans (code points) under the loss mask, for any template.
    """
    out = StructType([StructField("conv_id", rows.schema["conv_id"].dataType), *StructType.fromDDL(DIGEST if digest else FULL).fields])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        program = template.compile(source, {"escape": escape})
        messages = (
            (conv, {"role": role or "", "text": text or ""})
            for batch in batches
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)))
        )
        made: list[list] = []
        for conv, group in groupby(messages, key=lambda x: x[0]):
            pieces = program({"messages": (message for _, message in group)})
            made.append([conv, *(digested(pieces) if digest else whole(pieces))])
            if len(made) >= 1000 or not digest:
                yield emit(made, arrow)
                made = []
        if made:
            yield emit(made, arrow)

    dealt = rows.select("conv_id", "turn", "role", "text").repartition("conv_id")
    ordered = dealt.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return ordered.mapInArrow(run, out)


def digested(pieces: Iterator[template.Piece]) -> list:
    reader = _Reader()
    for piece, said in pieces:
        reader.add(piece, said)
    return reader.row()


def whole(pieces: Iterator[template.Piece]) -> list:
    texts, spans, at, n = [], [], 0, 0
    for piece, said in pieces:
        if said and piece:
            if spans and spans[-1]["end"] == at:
                spans[-1]["end"] += len(piece)
            else:
                spans.append({"start": at, "end": at + len(piece)})
        texts.append(piece)
        at += len(piece)
        n += piece.count("</s>")
    return [n, "".join(texts), spans]


