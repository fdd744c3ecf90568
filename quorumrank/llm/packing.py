"""Vector bin packing of training examples into token sequences, by the dot-product heuristic.

An example needs tokens, one segment and some loss-bearing tokens; a sequence has a limit on each. The open sequence
takes, of a bounded window of waiting examples that fit, the one whose needs (as shares of the limits) have the
largest dot product with what is left of the limits, so the scarcest resource decides. Each task packs its own rows:
nothing is gathered, memory is bounded by the window, and a lost task is packed again the same way.

Where examples may be cut and all their tokens bear loss, no sequence is padded but to a power of two: a sequence is
opened only as long as the largest waiting examples fill within its segments, and once whole examples would use up the
segments first, a longer one is cut to fill what is left.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import pick, row_chunks, tidy
from .word_tokens import word_tokens

SEQUENCE_TOKENS = 2048
SEQUENCE_SEGMENTS = 128
END_ID = 1
#: Waiting examples of a task.
WINDOW = 512


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most."""

    tokens: int = SEQUENCE_TOKENS
    segments: int = SEQUENCE_SEGMENTS
    loss: int = SEQUENCE_TOKENS


#: For instruction data: few conversations side by side, and not more to learn from than half of a sequence.
INSTRUCTIONS = Limits(segments=16, loss=SEQUENCE_TOKENS // 2)


@dataclass
class Example:
    """A run of tokens; ``loss`` marks those that bear loss (None: all of them)."""

    key: Any
    ids: bytes
    start: int
    length: int
    loss: np.ndarray | None = None
    loss_before: np.ndarray | None = field(default=None, repr=False)

    def loss_in(self, length: int) -> int:
        if self.loss is None:
            return length
        if self.loss_before is None:
            self.loss_before = np.concatenate([[0], np.cumsum(self.loss)])
        return int(self.loss_before[self.start + length] - self.loss_before[self.start])

    def longest(self, tokens: int, loss: int) -> int:
        """Longest beginning within both limits."""
        n = min(self.length, tokens)
        if self.loss is None:
            return min(n, loss)
        self.loss_in(0)
        return min(n, int(np.searchsorted(self.loss_before, self.loss_before[self.start] + loss, side="right")) - 1 - self.start)


#: (example, length of the piece, sequence, offset in it)
Placed = tuple[Example, int, int, int]


class Packer:
    """Packs a stream of examples. ``cut``: examples may be cut anywhere; else each lies whole in one sequence."""

    def __init__(self, limits: Limits = Limits(), cut: bool = True, window: int = WINDOW) -> None:
        self.limits, self.cut, self.window = limits, cut, window
        self._caps = np.array([limits.tokens, limits.segments, limits.loss], dtype=float)
        self._waiting: list[Example] = []
        self._needs, self._shares = np.zeros((3, window + 1)), np.zeros((3, window + 1))  # and as shares of the limits
        self._sequence = -1
        self._left = np.zeros(3, dtype=np.int64)
        self._capacity = 0

    def add(self, example: Example) -> Iterator[Placed]:
        if not self.cut and (example.length > self.limits.tokens or example.loss_in(example.length) > self.limits.loss):
            raise ValueError(f"example {example.key} exceeds a sequence: allow cuts or split it before")
        self._hold(example)
        while len(self._waiting) >= self.window:
            yield from self._place()

    def finish(self) -> Iterator[Placed]:
        while self._waiting:
            yield from self._place()

    def _hold(self, e: Example) -> None:
        at, needs = len(self._waiting), (e.length, 1, e.loss_in(e.length))
        self._needs[:, at] = needs
        self._shares[:, at] = needs / self._caps
        self._waiting.append(e)

    def _take(self, i: int) -> Example:
        last = len(self._waiting) - 1
        e = self._waiting[i]
        self._waiting[i] = self._waiting[last]
        self._needs[:, i], self._shares[:, i] = self._needs[:, last], self._shares[:, last]
        self._waiting.pop()
        return e

    def _open(self) -> None:
        """The next sequence. Where the largest waiting examples don't fill a full one within its segments (short ones, or
        the end of the stream), a stream that may be cut gets the longest power of two that they do fill."""
        self._sequence += 1
        tokens = self.limits.tokens
        if self.cut:
            lengths, most = self._needs[0, : len(self._waiting)], self.limits.segments
            total = int((lengths if len(lengths) <= most else np.partition(lengths, -most)[-most:]).sum())
            if total < tokens:
                tokens = 1 << (total.bit_length() - 1)
        self._capacity = tokens
        self._left = np.array([tokens, self.limits.segments, self.limits.loss], dtype=np.int64)

    def _place(self) -> Iterator[Placed]:
        if self._sequence < 0 or not self._left[0] or not self._left[1]:
            self._open()
        lengths, _, losses = self._needs[:, : len(self._waiting)]  # each needs one segment, and one at least is left
        fits = (lengths <= self._left[0]) & (losses <= self._left[2])
        worth = (self._left / self._caps) @ self._shares[:, : len(self._waiting)]
        i = int(np.argmax(np.where(fits, worth, -1.0)))
        whole = bool(fits[i])
        if whole and self.cut and lengths[i] * self._left[1] < self._left[0] and self._left[2] >= self._left[0]:
            whole = not (lengths > self._left[0]).any()  # else segments run out before tokens do
        if whole:
            e = self._take(i)
            length = e.length
        elif self.cut:
            tokens, loss = int(self._left[0]), int(self._left[2])
            if loss < tokens:
                longest = [e.longest(tokens, loss) for e in self._waiting]
                length = max(longest)
                i = longest.index(length)
            else:
                i, length = int(np.argmax(worth)), tokens
            if not length:
                self._left[0] = 0
                return
            e = self._take(i)
            length = min(length, e.length)
            if length < e.length:
                self._hold(Example(e.key, e.ids, e.start + length, e.length - length, e.loss, e.loss_before))
        else:
            self._left[0] = 0
            return
        yield e, length, self._sequence, self._capacity - int(self._left[0])
        self._left -= (length, 1, e.loss_in(length))


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = [x.split()[0] for x in _PIECES.split(", ")]


def pack_documents(docs: DataFrame, tokenizer: str, limits: Limits = Limits()) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its whole text and one end id; every id lies in exactly one piece. Null and empty
    texts are the end id alone. Sequences are full, but for the last ones of a task, which are powers of two long;
    sequence_id is the task's partition times 2**40 plus a count. Repeated rows are packed as often as they occur,
    null ids stay null. Other columns are ignored.
    """

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = word_tokens(tokenizer), Packer(limits)
        base = TaskContext.get().partitionId() << 40
        out: list[tuple] = []

        def row(placed: Placed) -> tuple:
            e, length, sequence, offset = placed
            crc = zlib.crc32(memoryview(e.ids)[4 * e.start : 4 * (e.start + length)])
            return e.key, e.start, length, crc, len(e.ids) // 4, base + sequence, offset

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * len(_NAMES)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _NAMES)

        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            texts = batch.column(1)
            keys = batch.column(0).to_pylist()
            for lo, hi in row_chunks(texts):
                for key, ids in zip(keys[lo:hi], words.encode(texts.slice(lo, hi - lo).to_pylist()), strict=True):
                    ids += end
                    out += [row(x) for x in packer.add(Example(key, ids, 0, len(ids) // 4))]
            if len(out) > 20_000:
                yield flush()
                out = []
        out += [row(x) for x in packer.finish()]
        yield flush()

    return pick(docs, "doc_id", "text").mapInArrow(tidy(act), _PIECES)


_TURNS = "conv_id long, first_turn long, start long, length long, loss_tokens long, ids_crc32 long, sequence_id long, offset long"
_TURN_NAMES = [x.split()[0] for x in _TURNS.split(", ")]


def pack_conversations(
    turns: DataFrame, tokenizer: str, limits: Limits = INSTRUCTIONS, bears_loss: str = "assistant"
) -> DataFrame:
    """One row per piece of ``turns(conv_id, turn, role, text)``, under all three limits.

    A conversation's ids are those of its turns in order, an end id after each; those of turns by ``bears_loss`` bear
    loss. It is cut only where it exceeds a sequence by itself, or where the range of turns that one task reads ends, so
    that one very long conversation needn't lie in one task; ``first_turn`` is the turn at which such a part begins and
    ``start`` the place of the piece in it. Null texts are the end id alone, a null role bears no loss, turns of a null
    conv_id are one conversation, turns with a null or repeated number follow each other by number, role and text. Other
    columns are ignored.
    """

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = word_tokens(tokenizer), Packer(limits, cut=False)
        base = TaskContext.get().partitionId() << 40
        out: list[tuple] = []
        end = np.array([END_ID], dtype="<u4").tobytes()
        part: list = [None, None, b"", np.zeros(0, bool), 0]  # conversation, first turn, ids, loss, place of the first id

        def row(placed: Placed) -> tuple:
            e, length, sequence, offset = placed
            conversation, first, start = e.key
            return conversation, first, start, length, e.loss_in(length), zlib.crc32(e.ids), base + sequence, offset

        def cut(all_of_it: bool) -> None:
            """Hands on what a sequence holds of the part, and its rest if ``all_of_it``."""
            while part[2]:
                e = Example((part[0], part[1], part[4]), part[2], 0, len(part[2]) // 4, part[3])
                n = e.longest(limits.tokens, limits.loss)
                if n == e.length and not all_of_it:
                    return
                out.extend(row(x) for x in packer.add(Example(e.key, e.ids[: 4 * n], 0, n, part[3][:n])))
                part[2:] = e.ids[4 * n :], part[3][n:], part[4] + n

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * len(_TURN_NAMES)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _TURN_NAMES)

        for batch in batches:
            conversations, numbers, roles, texts = (c.to_pylist() for c in batch.columns)
            for conversation, number, role, ids in zip(conversations, numbers, roles, words.encode(texts), strict=True):
                if not part[2] and not part[4] or conversation != part[0]:
                    cut(all_of_it=True)
                    part[:] = conversation, number, b"", np.zeros(0, bool), 0
                ids += end
                part[2] += ids
                part[3] = np.append(part[3], np.full(len(ids) // 4, role == bears_loss))
                cut(all_of_it=False)
            if len(out) > 20_000:
                yield flush()
        cut(all_of_it=True)
        out.extend(row(x) for x in packer.finish())
        yield flush()

    order = ("conv_id", "turn", "role", "text")
    rows = pick(turns, *order)
    return rows.repartitionByRange(*order[:2], F.xxhash64("role", "text")).sortWithinPartitions(*order).mapInArrow(tidy(act), _TURNS)
