"""Chat formatting: a finite-state machine over roles checks the order of turns, a declarative template makes the text.

Rows of a conversation stream through their task in order, so a conversation of any length needs one row of memory.
Each turn becomes segments of text with a loss flag: header, body, end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """``header`` has one ``{role}``; ``controls`` are strings that only the template may write. ``loss`` are the roles
    whose bodies are learned; ``moves`` gives the roles that may follow each role (``start`` before the first turn), and
    ``final`` the roles that may end a conversation.

    In bodies and role names the escape character is doubled in kind (escape + ``e``), and escape + ``x`` is put behind
    the first character of every control string, so none is left; reading takes both away again.
    """

    header: str = "<|turn|>{role}<|text|>"
    end: str = "<|end|>"
    controls: tuple[str, ...] = (
        "<|turn|>", "<|text|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>", "<|endoftext|>",
    )
    escape: str = "\x1b"
    loss: tuple[str, ...] = ("assistant",)
    moves: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    final: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        before, between = self.marks
        if not (before and between and self.end) or self.header.count("{role}") != 1 or len(self.escape) != 1:
            raise ValueError("header needs text around one {role}, end is not empty, escape is one character")
        if not {before, between, self.end} <= set(self.controls):
            raise ValueError("the template's own marks are control strings")
        if any(self.escape in c or c[0] in c[1:] or len(c) < 2 for c in self.controls):
            # Then a text's end and the mark behind it could form a control string that neither holds.
            raise ValueError("a control string has no escape and its first character only at its start")
        if any(c[0] not in "<[" or set(c[1:]) & {"<", "["} for c in self.controls):
            raise ValueError("control strings begin with < or [ and have neither inside")

    @property
    def marks(self) -> tuple[str, str]:
        before, _, between = self.header.partition("{role}")
        return before, between

    def escaped(self, text: str) -> str:
        text = text.replace(self.escape, self.escape + "e")
        for c in self.controls:
            text = text.replace(c, f"{c[0]}{self.escape}x{c[1:]}")
        return text

    def unescaped(self, text: str) -> str:
        return text.replace(self.escape + "x", "").replace(self.escape + "e", self.escape)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        before, between = self.marks
        return [
            (before + self.escaped(role) + between, False),
            (self.escaped(text), role in self.loss),
            (self.end, False),
        ]

    def turns(self, formatted: str) -> Iterator[tuple[str, str]]:
        """Role and text of every turn of a formatted text."""
        before, between = self.marks
        at = 0
        while at < len(formatted):
            if not formatted.startswith(before, at):
                raise ValueError("not a formatted conversation")
            middle = formatted.index(between, at)
            stop = formatted.index(self.end, middle)
            role = formatted[at + len(before) : middle]
            yield self.unescaped(role), self.unescaped(formatted[middle + len(between) : stop])
            at = stop + len(self.end)


SEGMENTS = "conv_id long, turn long, place int, text string, loss boolean, error string"


def _format(template: ChatTemplate):
    """Segments of sorted turns; the machine's state is the role before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state, number = object(), "start", 0
        for batch in batches:
            rows = []
            for conv_id, role, text, last in zip(
                *(batch[c].to_pylist() for c in ("conv_id", "role", "text", "last")), strict=True
            ):
                if conv_id != here:
                    here, state, number = conv_id, "start", 0
                error = None
                if role not in template.moves.get(state, ()):
                    error = f"{role or 'no role'} after {state}"
                elif last and role not in template.final:
                    error = f"ends with {role}"
                for place, (part, loss) in enumerate(template.segments(role, text)):
                    rows.append((conv_id, number, place, part, loss, error if place == 0 else None))
                state, number = role, number + 1
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["conv_id", "turn", "place", "text", "loss", "error"],
            )

    return run


def format_chats(turns: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Segments ``conv_id, turn, place, text, loss, error`` of all conversations, in order inside each task.

    ``turns`` has ``conv_id, turn, role, text``. Turns are ordered by ``turn`` (nulls first), then role and text, and
    numbered anew from 0; repeated rows are turns of their own. Null role or text is the empty string; rows without
    conv_id are one conversation. A turn that the machine does not allow is formatted all the same, with ``error`` on its
    header. Other columns are ignored; an empty table gives an empty result.
    """
    asked = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = ["conv_id", "turn", "role", "text"]
    dealt = asked.repartition("conv_id").sortWithinPartitions(*order)
    return dealt.mapInArrow(_last, "conv_id long, role string, text string, last boolean").mapInArrow(
        _format(template), SEGMENTS
    )


def _last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mark the last row of each run of equal conv_id; one row is held back from batch to batch."""
    names = ["conv_id", "role", "text"]
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch.select(names)])
        rows = rows if held is None else pa.concat_tables([held, rows])
        rows = rows.combine_chunks()
        ids = rows["conv_id"].to_pylist()
        held = rows.slice(len(ids) - 1)
        if len(ids) > 1:
            last = [a != b for a, b in zip(ids, ids[1:], strict=False)]
            yield from rows.slice(0, len(ids) - 1).append_column("last", pa.array(last, pa.bool_())).combine_chunks().to_batches()
    if held is not None:
        yield from held.append_column("last", pa.array([True], pa.bool_())).combine_chunks().to_batches()


def read_back(segments: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Digests of conversations, read from the formatted text of their segments.

    Returns ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid, errors``.
    """
    names = ["conv_id", "turn", "place", "text", "loss", "error"]
    dealt = segments.select(*names).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "place")
    return dealt.mapInArrow(_digest(template), DIGESTS)


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "valid boolean, errors string"
)


def _digest(template: ChatTemplate):
    def run(batches):
        here, state = object(), None

        def result():
            conv_id, n, turns, chars, loss, size, errors, rest = state
            if rest:
                raise ValueError(f"conversation {conv_id} ends inside a turn")
            return (conv_id, n, turns.hexdigest(), chars, loss.hexdigest(), size, not errors, "; ".join(errors))

        for batch in batches:
            done = []
            for conv_id, text, loss, error in zip(
                *(batch[c].to_pylist() for c in ("conv_id", "text", "loss", "error")), strict=True
            ):
                if conv_id != here:
                    if state:
                        done.append(result())
                    here, state = conv_id, [conv_id, 0, sha256(), 0, sha256(), 0, [], ""]
                state[5] += len(text)
                if error and len(state[6]) < 3:
                    state[6].append(error)
                if loss:
                    plain = template.unescaped(text)
                    state[3] += len(plain)
                    state[4].update(plain.encode())
                # A turn is read from the running text as soon as its end is there.
                state[7] += text
                if state[7].endswith(template.end):
                    for role, body in template.turns(state[7]):
                        state[1] += 1
                        state[2].update(f"{role}\n{body}\n".encode())
                    state[7] = ""
            yield _digests(done)
        if state:
            yield _digests([result()])

    return run


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.string())
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid", "errors"],
    )
