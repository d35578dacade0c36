"""Chat formatting (operator 13): a grammar that is read back, and escapes until it reads back identically.

A formatted conversation is ``<s>`` and its turns:

    user        ``[INST] text [/INST]``
    system      ``<<SYS>> text <</SYS>>``
    assistant   `` text</s>``
    other       ``[ROLE] name [SAYS] text [/ROLE]``

A control string inside a text is escaped by backslashes after its first
character: with k of them in the source it has k + 1 in the output, so the
escape is undone by taking one away.  Control strings neither overlap nor hold
one another, whatever their backslashes, so this is one to one.

Rendering starts from the plain text.  The deterministic parser reads the
piece back; where it stops early, fails or finds another text, the control
string at that place is the conflict, and all of its kind in the turn are
escaped before the next try.  The kinds are nine, so there are ten tries at
most, each linear.  The parser reads a turn without looking beyond its closing
string, so turns that read back alone read back in a conversation; reading a
conversation compares every recovered turn with a checksum of its source.

Rows are rendered where they are; the pieces are then shuffled by conversation,
sorted and streamed, so a task holds one part of ``part_chars``, not a
conversation, however many rows one has.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import slices

BEGIN = "<s>"
OPENING = {"user": "[INST] ", "system": "<<SYS>> ", "assistant": " "}
CLOSING = {"user": " [/INST]", "system": " <</SYS>>", "assistant": "</s>"}
NAMED, SAYS, NAMED_END = "[ROLE] ", " [SAYS] ", " [/ROLE]"
CONTROL = re.compile(r"<\\*(?:s>|/s>|<SYS>>|</SYS>>)|\[\\*(?:INST\]|/INST\]|ROLE\]|SAYS\]|/ROLE\])")
PART_CHARS = 4 << 20

PIECES = "conv_id long, turn long, role string, piece string, loss_start int, loss_end int, source binary"
PARTS = "conv_id long, part int, text string, loss array<struct<start: int, end: int>>, sources array<binary>"


class GrammarError(ValueError):
    """The text leaves the grammar at ``at``."""

    def __init__(self, at: int):
        super().__init__(f"not in the grammar at {at}")
        self.at = at


@dataclass(frozen=True)
class Turn:
    """A turn read back: its body lies at ``start:end`` of the formatted text and the next turn begins at ``after``."""

    role: str
    text: str
    start: int
    end: int
    after: int


def kind(control: str) -> str:
    return control.replace("\\", "")


def escape(text: str, kinds: set[str]) -> str:
    if not kinds:
        return text
    return CONTROL.sub(lambda m: m.group()[0] + "\\" + m.group()[1:] if kind(m.group()) in kinds else m.group(), text)


def unescape(text: str) -> str:
    return CONTROL.sub(lambda m: m.group().replace("\\", "", 1), text)


def _until(text: str, at: int, closing: str) -> int:
    """Where the field that begins at ``at`` ends: before ``closing``, the first control string without a backslash."""
    control = closing.strip()
    for m in CONTROL.finditer(text, at):
        if m.group()[1] == "\\":
            continue
        end = m.start() + len(control) - len(closing.rstrip())
        if m.group() != control or end < at or not text.startswith(closing, end):
            raise GrammarError(m.start())
        return end
    raise GrammarError(len(text))


def parse_turn(text: str, at: int = 0) -> Turn:
    """The turn that begins at ``at``."""
    if text.startswith(NAMED, at):
        name = at + len(NAMED)
        named = _until(text, name, SAYS)
        role, start, closing = unescape(text[name:named]), named + len(SAYS), NAMED_END
    else:
        role = next((r for r, opening in OPENING.items() if text.startswith(opening, at)), None)
        if role is None:
            raise GrammarError(at)
        start, closing = at + len(OPENING[role]), CLOSING[role]
    end = _until(text, start, closing)
    return Turn(role, unescape(text[start:end]), start, end, end + len(closing))


def parse(text: str) -> list[Turn]:
    """All turns of a formatted conversation."""
    if not text.startswith(BEGIN):
        raise GrammarError(0)
    turns, at = [], len(BEGIN)
    while at < len(text):
        turns.append(parse_turn(text, at))
        at = turns[-1].after
    return turns


def _wrapped(role: str, text: str, kinds: set[str]) -> str:
    text = escape(text, kinds)
    if role in OPENING:
        return OPENING[role] + text + CLOSING[role]
    return NAMED + escape(role, kinds) + SAYS + text + NAMED_END


def _conflict(piece: str, role: str, text: str, kinds: set[str]) -> str | None:
    """The kind of control string at which reading ``piece`` back departs from its source; None if it does not."""
    try:
        got = parse_turn(piece)
    except GrammarError as e:
        return kind(CONTROL.match(piece, e.at).group())
    if got.after != len(piece):  # closed early
        return kind(CONTROL.search(piece, got.end).group())
    for mine, source, at in ((got.role, role, len(NAMED)), (got.text, text, got.start)):
        if mine != source:  # a backslash was taken away though none had been added
            escaped = (kind(m.group()) for m in CONTROL.finditer(piece, at) if m.group()[1] == "\\")
            return next(k for k in escaped if k not in kinds)
    return None


def render(role: str, text: str) -> tuple[str, Turn]:
    """A turn's formatted piece and how it reads back; conflicting kinds of control strings are escaped until it is the source."""
    kinds: set[str] = set()
    while True:
        piece = _wrapped(role, text, kinds)
        found = _conflict(piece, role, text, kinds)
        if found is None:
            return piece, parse_turn(piece)
        kinds.add(found)


def source_sum(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)} {role}{text}".encode("utf-8", "surrogatepass"), digest_size=8).digest()


# ---------------------------------------------------------------- on Spark


def format_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``PIECES``: every row rendered alone, with the code points under the loss mask (assistant texts).

    A null role counts as the empty name, a null text as the empty text.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            pieces, starts, ends, sums = [], [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                role, text = role or "", text or ""
                piece, turn = render(role, text)
                pieces.append(piece)
                starts.append(turn.start if role == "assistant" else None)
                ends.append(turn.end if role == "assistant" else None)
                sums.append(source_sum(role, text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), batch.column("role"), pa.array(pieces, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(sums, pa.binary())],
                ["conv_id", "turn", "role", "piece", "loss_start", "loss_end", "source"],
            )

    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, PIECES)


def format_conversations(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", part_chars: int = PART_CHARS) -> DataFrame:
    """``PARTS``: the formatted text of every conversation, its loss mask and its sources' checksums, in order.

    The parts of a conversation, numbered from 0, follow one another in one
    partition; a part ends after the turn that brings it to ``part_chars``, so
    ordinary conversations have one.  Mask intervals are code points of the
    part.  Rows are ordered by turn (null first); rows of one turn number by
    role (null first), then by their formatted text; repeated rows all stay.
    Rows without a conversation id are one conversation.  An empty table gives
    no rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "part", "text", "loss", "sources"]
        types = [pa.int64(), pa.int32(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.list_(pa.binary())]
        ready: list[list] = [[] for _ in names]
        current, part, texts, size, loss, sums, held = None, -1, [], 0, [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if ready[0]:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(ready, types)], names)
                for v in ready:
                    v.clear()

        def close() -> None:
            for v, x in zip(ready, (current[0], part, "".join(texts), list(loss), list(sums))):
                v.append(x)
            for v in (texts, loss, sums):
                v.clear()

        for batch in slices(batches, "piece"):
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "piece", "loss_start", "loss_end", "source")]
            for conv, piece, start, end, source in zip(*columns):
                if current != (conv,):
                    if texts:
                        close()
                    current, part, size = (conv,), 0, len(BEGIN)
                    texts.append(BEGIN)
                elif size >= part_chars:
                    close()
                    part, size = part + 1, 0
                if start is not None:
                    loss.append({"start": size + start, "end": size + end})
                texts.append(piece)
                sums.append(source)
                size += len(piece)
                held += len(piece)
                if held >= part_chars:
                    yield from flush()
                    held = 0
        if texts:
            close()
        yield from flush()

    turns = format_turns(conversations, conv_col, turn_col, role_col, text_col)
    return turns.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "role", "piece").mapInArrow(work, PARTS)


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame, in_order: bool = False) -> DataFrame:
    """``READ``: what a parser recovers from ``PARTS``: turns, text under the loss mask, and their digests.

    ``turns_sha256`` covers role, newline, text, newline per turn; ``loss_sha256``
    all masked text, unescaped.  A turn that differs from its source's checksum
    is an error.  ``in_order`` spares the shuffle where the parts are as
    ``format_conversations`` returns them.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, n, chars, masked, turns, loss = None, 0, 0, 0, None, None
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

        def row() -> tuple:
            return current[0], n, turns.hexdigest(), masked, loss.hexdigest(), chars

        for batch in slices(batches):
            rows = []
            for conv, text, mask, sums in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "loss", "sources"))):
                at = 0
                if current != (conv,):
                    if current:
                        rows.append(row())
                    if not text.startswith(BEGIN):
                        raise GrammarError(0)
                    current, n, chars, masked, turns, loss, at = (conv,), 0, 0, 0, hashlib.sha256(), hashlib.sha256(), len(BEGIN)
                for source in sums:
                    turn = parse_turn(text, at)
                    if source_sum(turn.role, turn.text) != source:
                        raise ValueError(f"conversation {conv}: turn {n} does not read back as its source")
                    turns.update(f"{turn.role}\n{turn.text}\n".encode("utf-8", "surrogatepass"))
                    at, n = turn.after, n + 1
                if at != len(text):
                    raise GrammarError(at)
                for m in mask:
                    said = unescape(text[m["start"] : m["end"]])
                    loss.update(said.encode("utf-8", "surrogatepass"))
                    masked += len(said)
                chars += len(text)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names)
        if current:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row(), types)], names)

    parts = formatted.select("conv_id", "part", "text", "loss", "sources")
    if not in_order:
        parts = parts.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "part")
    return parts.mapInArrow(work, READ)
