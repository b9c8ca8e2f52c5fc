"""Chat formatting with typed content parts (operator 6).

A visitor flattens the parts of a turn in order: text is escaped and written
out; an image, audio or document part becomes a numbered placeholder, its
reference is recorded and its expanded token count added.  The template marks
turns as ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside texts a backslash is
put into every ``<|`` (and one more into every ``<\\|``, ``<\\\\|`` ...), so no
control string can come from a text and the step is undone exactly.

The output is one row per turn, in order within its conversation; a formatted
conversation is the concatenation of its pieces.  Rows are dealt by
conversation and streamed in order, so a conversation of any length needs the
memory of one turn.  ``read_back`` parses the pieces again.

Defined cases: null text counts as empty, a null role as an empty one, null
parts as none, a part of unknown type as a document; a null turn comes first
and equal turns are ordered by role and content; rows with a null conv_id form
one conversation; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
PART = "struct<type:string,text:string,ref:string,units:int>"
ATTACHMENT = "struct<number:int,type:string,ref:string,tokens:int>"
PIECE = (f"conv_id long, n long, piece string, loss_start int, loss_length int, "
         f"attachments array<{ATTACHMENT}>, tokens long")
# Tokens that stand for one unit (image tile, second of audio, document page).
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 512}

_OPEN, _SHUT = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
_HOLDER = re.compile(r"<\|(image|audio|document) (\d+)\|>")


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _SHUT.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """Roles stand on one line: line ends and backslashes are escaped as well."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Flattener:
    """Visits the parts of one conversation's turns; numbers run through."""

    def __init__(self, tokens_per_unit: dict[str, int]):
        self.tokens_per_unit = tokens_per_unit
        self.number = 0

    def turn(self, parts: list[dict]) -> tuple[str, list[dict], int]:
        """Flat content, attachments and expanded token count of a turn."""
        self.out, self.attachments, self.tokens = [], [], 0
        for part in parts:
            visit = getattr(self, f"visit_{part['type']}", self.visit_document)
            visit(part)
        return "".join(self.out), self.attachments, self.tokens

    def visit_text(self, part: dict) -> None:
        text = part["text"] or ""
        self.out.append(escape(text))
        self.tokens += len(text.split())

    def visit_image(self, part: dict) -> None:
        self._attach("image", part)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part)

    def visit_document(self, part: dict) -> None:
        self._attach("document", part)
        if part["text"]:
            self.visit_text(part)

    def _attach(self, kind: str, part: dict) -> None:
        self.number += 1
        tokens = self.tokens_per_unit[kind] * max(1, part["units"] or 1)
        self.out.append(f"<|{kind} {self.number}|>")
        self.attachments.append({"number": self.number, "type": kind, "ref": part["ref"], "tokens": tokens})
        self.tokens += tokens


def text_part(text: str):
    """A column of parts that holds one text."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("units")))


def format_turns(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",),
                 tokens_per_unit: dict[str, int] | None = None) -> DataFrame:
    """One formatted piece per turn (conv_id, turn, role, parts), in order.

    ``loss_start`` and ``loss_length`` (code points of the piece) mark what a
    model is trained on: the whole content of a turn whose role is among
    ``loss_roles``.
    """
    per_unit = {**TOKENS_PER_UNIT, **(tokens_per_unit or {})}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started, conv, flat, n = False, None, None, 0
        schema = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if not started or row["conv_id"] != conv:
                    started, conv, flat, n = True, row["conv_id"], Flattener(per_unit), 0
                role = row["role"] or ""
                content, attachments, tokens = flat.turn(row["parts"] or [])
                head = f"{START}{escape_role(role)}\n"
                loss = len(content) if role in loss_roles else 0
                out.append({"conv_id": conv, "n": n, "piece": head + content + END, "loss_start": len(head),
                            "loss_length": loss, "attachments": attachments, "tokens": tokens})
                n += 1
            schema = schema or pa.schema([
                ("conv_id", pa.int64()), ("n", pa.int64()), ("piece", pa.string()), ("loss_start", pa.int32()),
                ("loss_length", pa.int32()), ("attachments", pa.list_(pa.struct([
                    ("number", pa.int32()), ("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int32())]))),
                ("tokens", pa.int64())])
            yield pa.RecordBatch.from_pylist(out, schema)

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role",
                        F.col("parts").cast(f"array<{PART}>").alias("parts"))
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", F.to_json("parts"))
            .mapInArrow(run, PIECE))


def parse(formatted: str) -> list[tuple[str, list[tuple[str, str | int]]]]:
    """(role, parts) of each turn; a part is ("text", text) or (kind, number)."""
    out = []
    for m in _TURN.finditer(formatted):
        parts, at = [], 0
        for h in _HOLDER.finditer(m[2]):
            if h.start() > at:
                parts.append(("text", unescape(m[2][at:h.start()])))
            parts.append((h[1], int(h[2])))
            at = h.end()
        if at < len(m[2]) or not parts:
            parts.append(("text", unescape(m[2][at:])))
        out.append((unescape_role(m[1]), parts))
    return out


def read_back(pieces: DataFrame) -> DataFrame:
    """Per conversation, from its formatted pieces alone: turns and their digest
    (role, LF, text, LF each), what lies under the loss mask, and the length.

    Streams the pieces where they are (those of a conversation lie together,
    in order, as ``format_turns`` leaves them).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def row():
            conv, n, turns, chars, loss, size = state
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(
                    (conv, n, turns.hexdigest(), chars, loss.hexdigest(), size),
                    (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            for r in batch.to_pylist():
                if state is None or r["conv_id"] != state[0]:
                    if state is not None:
                        yield row()
                    state = [r["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, parts in parse(r["piece"]):
                    content = "".join(x for kind, x in parts if kind == "text")
                    state[1] += 1
                    state[2].update(f"{role}\n{content}\n".encode())
                if r["loss_length"]:
                    begin = r["loss_start"]
                    masked = unescape(_HOLDER.sub("", r["piece"][begin:begin + r["loss_length"]]))
                    state[3] += len(masked)
                    state[4].update(masked.encode())
                state[5] += len(r["piece"])
        if state is not None:
            yield row()

    return pieces.select("conv_id", "piece", "loss_start", "loss_length").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
