"""Chat formatting of typed content parts.

A message is a role and an ordered list of parts. A visitor flattens them: text is escaped, an
image, audio or document becomes a placeholder that names its turn and place, and its reference
and the number of tokens it expands to are recorded. The output has one row per turn, and the rows
of a conversation in order are its formatted text, so a conversation of any length needs no task
that holds it.

    ### role: text</turn>

Control strings inside roles and texts get a backslash, as does every backslash, so reading back
is exact. The loss mask of a turn is a list of spans over its formatted text: the texts of the
roles to be learned.

Defined results: null text and null role are empty; turns are ordered by turn, then role, then
text, nulls first; equal rows are turns of their own; a null conv_id is one conversation; a null
list of parts is an empty turn, and a part of unknown type is an error; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumflow.llm.staging import staged

START, BETWEEN, END = "### ", ": ", "</turn>\n"
LEARNED = ("assistant",)
# What a backslash can stand before. A role also hides its colon.
_CONTROL = re.compile(r"\\|###|</turn>|<\|")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|<\||:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|<\||:)")
_TURN = re.compile(r"### ((?:[^\\:]|\\(?:\\|###|</turn>|<\||:))*): (.*)</turn>\n", re.DOTALL)

PART = (
    "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
)
FORMATTED = (
    "formatted string, mask array<struct<start:bigint,end:bigint>>,"
    " attachments array<struct<type:string,uri:string,at:bigint,tokens:bigint>>, n_tokens bigint"
)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m.group(), text)


def escape_role(role: str) -> str:
    return _ROLE_CONTROL.sub(lambda m: "\\" + m.group(), role)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m.group(1), text)


@dataclass(frozen=True)
class Costs:
    """Tokens that parts expand to."""

    bytes_per_token: int = 4
    patch: int = 28  # pixels along an image patch, one token each
    per_second: float = 25.0
    per_page: int = 600


class Flatten:
    """Visits the parts of one turn in order."""

    def __init__(self, turn: int | None, costs: Costs) -> None:
        self.turn = turn
        self.costs = costs
        self.pieces: list[str] = []
        self.spans: list[tuple[int, int]] = []
        self.attachments: list[dict] = []
        self.length = 0
        self.tokens = 0

    def visit(self, part: dict) -> None:
        kinds = {"text": self.text, "image": self.image, "audio": self.audio, "document": self.document}
        if part["type"] not in kinds:
            raise ValueError(f"unknown part type {part['type']!r}")
        kinds[part["type"]](part)

    def _put(self, piece: str) -> int:
        at = self.length
        self.pieces.append(piece)
        self.length += len(piece)
        return at

    def text(self, part: dict) -> None:
        text = part["text"] or ""
        at = self._put(escape(text))
        self.spans.append((at, self.length))
        self.tokens += -(-len(text.encode()) // self.costs.bytes_per_token)

    def _attach(self, part: dict, tokens: int) -> None:
        name = f"<|{part['type']} {self.turn}.{len(self.attachments)}|>"
        at = self._put(name)
        self.attachments.append({"type": part["type"], "uri": part["uri"], "at": at, "tokens": tokens})
        self.tokens += tokens

    def image(self, part: dict) -> None:
        across, down = (-(-(part[k] or 0) // self.costs.patch) for k in ("width", "height"))
        self._attach(part, max(1, across * down))

    def audio(self, part: dict) -> None:
        self._attach(part, max(1, math.ceil((part["seconds"] or 0) * self.costs.per_second)))

    def document(self, part: dict) -> None:
        self._attach(part, max(1, (part["pages"] or 0) * self.costs.per_page))


def format_turn(turn, role: str | None, parts: list[dict] | None, costs: Costs, learned) -> dict:
    """The formatted text of a turn, its loss mask, attachments and tokens."""
    flat = Flatten(turn, costs)
    head = START + escape_role(role or "") + BETWEEN
    flat._put(head)
    for part in parts or []:
        flat.visit(part)
    flat._put(END)
    return {
        "formatted": "".join(flat.pieces),
        "mask": [{"start": a, "end": b} for a, b in flat.spans] if role in learned else [],
        "attachments": flat.attachments,
        "n_tokens": flat.tokens,
    }


def format_messages(
    messages: DataFrame, costs: Costs = Costs(), learned: tuple[str, ...] = LEARNED
) -> DataFrame:
    """conv_id, turn and the formatted turn of each message (conv_id, turn, role, parts)."""

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns, roles, parts = (batch.column(c).to_pylist() for c in ("turn", "role", "parts"))
            rows = [format_turn(t, r, p, costs, learned) for t, r, p in zip(turns, roles, parts)]
            kinds = {
                "formatted": pa.string(),
                "mask": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
                "attachments": pa.list_(
                    pa.struct([("type", pa.string()), ("uri", pa.string()), ("at", pa.int64()), ("tokens", pa.int64())])
                ),
                "n_tokens": pa.int64(),
            }
            made = [pa.array([r[k] for r in rows], kind) for k, kind in kinds.items()]
            yield pa.record_batch(
                [batch.column("conv_id"), batch.column("turn"), *made], ["conv_id", "turn", *kinds]
            )

    kinds = ", ".join(f"{c} {messages.schema[c].dataType.simpleString()}" for c in ("conv_id", "turn"))
    return messages.select("conv_id", "turn", "role", "parts").mapInArrow(form, f"{kinds}, {FORMATTED}")


def text_messages(turns: DataFrame) -> DataFrame:
    """Messages of one text part each from rows (conv_id, turn, role, text)."""
    empty = {"uri": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    part = F.struct(
        F.lit("text").alias("type"), "text", *[F.lit(None).cast(t).alias(c) for c, t in empty.items()]
    )
    return turns.select("conv_id", "turn", "role", F.array(part).alias("parts"))


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn, read back; placeholders stay in the text."""
    match = _TURN.fullmatch(formatted)
    if not match:
        raise ValueError("not a formatted turn")
    return unescape(match.group(1)), unescape(match.group(2))


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what its formatted turns hold, read back from them.

    Turns are read where they are; then roles and texts are sorted by conversation and hashed as a
    stream, which keeps one hash state however long the conversation is.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, masks = batch.column("formatted").to_pylist(), batch.column("mask").to_pylist()
            turns = [read_turn(t) for t in texts]
            learned = ["".join(unescape(t[m["start"] : m["end"]]) for m in ms) for t, ms in zip(texts, masks)]
            columns = [[r for r, _ in turns], [t for _, t in turns], learned]
            yield pa.record_batch(
                [
                    batch.column("conv_id"),
                    batch.column("turn"),
                    *[pa.array(c, pa.string()) for c in columns],
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["conv_id", "turn", "role", "text", "learned", "chars"],
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = object()
        now, state = nothing, None

        def result() -> pa.RecordBatch:
            n, turns, loss, learned, chars = state
            values = [now, n, turns.hexdigest(), loss, learned.hexdigest(), chars]
            columns = [pa.array([v], t) for v, t in zip(values, kinds)]
            return pa.record_batch(columns, names)

        kinds = [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        for batch in batches:
            kinds[0] = batch.column("conv_id").type
            rows = zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "learned", "chars")])
            for conv, role, text, learned, chars in rows:
                if now is nothing or conv != now:
                    if state:
                        yield result()
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += chars
        if state:
            yield result()

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kind = {c: formatted.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    turns = formatted.select("conv_id", "turn", "formatted", "mask").mapInArrow(
        read,
        f"conv_id {kind['conv_id']}, turn {kind['turn']}, role string, text string, learned string,"
        " chars bigint",
    )
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(
        digest,
        f"conv_id {kind['conv_id']}, n_turns bigint, turns_sha256 string, loss_chars bigint,"
        " loss_sha256 string, formatted_chars bigint",
    )


def format_conversations(turns: DataFrame) -> DataFrame:
    """Formatted turns, written down, of rows (conv_id, turn, role, text)."""
    return staged(format_messages(text_messages(turns)), "chat-formatted")
