"""Tokens of many texts at once: where they are, a key for each, and how often each occurs.

Texts come as one run of bytes; it is worked through in pieces of ``PIECE_BYTES`` that end with a text
or, within a text longer than that, after a blank, so that the memory of a task does not grow with the
length of a text. Only a single token longer than a piece is taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from opinara.llm.kernels import BASE, BLANK, mix

PIECE_BYTES, KEPT_TOKENS = 4 << 20, 1 << 20
WIDE = 8  # bytes that a key takes in at a time, and the zeros behind each piece
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
# The low 0 to 8 bytes of a 64-bit value.
MASKS = np.array([(1 << (8 * n)) - 1 for n in range(WIDE + 1)], np.uint64)


@dataclass(frozen=True)
class Piece:
    """Bytes of rows ``first`` on, A to Z in lower case unless they are to stay, ``WIDE`` zeros behind them.

    ``starts`` holds where each row's text begins, or goes on if ``inside`` for the first; ``ended`` of
    the rows end here, which are all of them, or all but the last.
    """

    first: int
    inside: bool
    data: np.ndarray
    starts: np.ndarray
    ended: int

    def __len__(self) -> int:
        return len(self.starts)


def _cut(data: np.ndarray, begin: int, at: int, stop: int) -> int:
    """Where to end a piece of a long text: after its last blank before ``at``, or its first one behind."""
    blanks = np.flatnonzero(BLANK[data[begin:at]])
    if len(blanks):
        return begin + int(blanks[-1]) + 1
    for place in range(at, stop, PIECE_BYTES):
        blanks = np.flatnonzero(BLANK[data[place : min(place + PIECE_BYTES, stop)]])
        if len(blanks):
            return place + int(blanks[0]) + 1
    return stop


def pieces(column: pa.Array, limit: int = PIECE_BYTES, lower: bool = True) -> Iterator[Piece]:
    column = column.cast(pa.large_string())
    count = len(column)
    if not count:
        return
    _, places, values = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + count + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    row, at, inside = 0, int(offsets[0]), False
    while row < count:
        last = int(np.searchsorted(offsets, at + limit, "right")) - 1  # rows before it end within the limit
        if last > row:
            stop, rows, ended = int(offsets[last]), last - row, last - row
        else:
            stop = _cut(data, at, at + limit, int(offsets[row + 1]))
            rows, ended = 1, int(stop == offsets[row + 1])
        padded = np.zeros(stop - at + WIDE, np.uint8)
        padded[: stop - at] = LOWER[data[at:stop]] if lower else data[at:stop]
        yield Piece(row, inside, padded, np.maximum(offsets[row : row + rows] - at, 0), ended)
        row, at, inside = row + ended, stop, not ended


@dataclass(frozen=True)
class Spans:
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray  # of the piece


def blank_free(data: np.ndarray) -> np.ndarray:
    solid = ~BLANK[data]
    solid[len(data) - WIDE :] = False
    return solid


def spans(piece: Piece, solid: np.ndarray) -> Spans:
    """Maximal runs of ``solid`` bytes; none goes from one text into the next."""
    before = np.zeros(len(solid), bool)
    before[1:] = solid[:-1]
    before[piece.starts] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.zeros(len(solid), bool)
    after[:-1] = solid[1:]
    after[piece.starts[piece.starts > 0] - 1] = False
    ends = np.flatnonzero(solid & ~after) + 1
    return Spans(starts, ends, np.searchsorted(piece.starts, starts, "right") - 1)


def keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, eight at a time, scrambled after each step.

    ``data`` has ``WIDE`` bytes behind the last span.
    """
    eights = np.lib.stride_tricks.as_strided(data[:WIDE].view(np.uint64), (len(data) - WIDE + 1,), (1,))
    length = ends - starts
    total = mix(length.astype(np.uint64) + BASE)
    live, step = np.arange(len(starts)), 0
    while len(live):
        if step:
            live = live[length[live] > step]
        whole = step == 0
        at = starts if whole else starts[live]
        left = np.minimum((length if whole else length[live]) - step, WIDE)
        taken = eights[at + step] & MASKS[left]
        found = mix((total if whole else total[live]) * BASE + taken)
        if whole:
            total = found
        else:
            total[live] = found
        step += WIDE
    return total


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans' bytes one after the other, and the offsets between them."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    at = np.repeat(starts - offsets[:-1], ends - starts)
    at += np.arange(len(at))
    return data[at], offsets


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, *buffers[1:]).cast(pa.string())


class Tally:
    """Distinct tokens with sums, merged as pieces come in and handed on when there are many."""

    def __init__(self, limit: int = KEPT_TOKENS):
        self.limit, self.parts, self.held = limit, [], 0

    def add(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sums: list[np.ndarray]) -> Iterator[pa.Array]:
        """Yield ``words, *sums`` of what is full."""
        if not len(starts):
            return
        key = keys(data, starts, ends)
        self.parts.append(self._distinct(key, data, starts, ends, sums))
        self.held += len(self.parts[-1][0])
        if self.held > self.limit:
            self._merge()
            if self.held > self.limit // 2:
                yield from self.drain()

    @staticmethod
    def _distinct(key, data, starts, ends, sums):
        order = np.argsort(key)
        key = key[order]
        bounds = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        one = order[bounds]
        text, offsets = gathered(data, starts[one], ends[one])
        return key[bounds], text, offsets, [np.add.reduceat(s[order], bounds) for s in sums]

    def _merge(self) -> None:
        if len(self.parts) > 1:
            grown = np.concatenate([[0], np.cumsum([len(p[1]) for p in self.parts])])
            starts = np.concatenate([p[2][:-1] + base for p, base in zip(self.parts, grown)])
            ends = np.concatenate([p[2][1:] + base for p, base in zip(self.parts, grown)])
            sums = [np.concatenate(s) for s in zip(*(p[3] for p in self.parts))]
            key, text = (np.concatenate([p[i] for p in self.parts]) for i in (0, 1))
            self.parts = [self._distinct(key, text, starts, ends, sums)]
        self.held = len(self.parts[0][0]) if self.parts else 0

    def drain(self) -> Iterator[list[pa.Array]]:
        self._merge()
        if self.held:
            _, text, offsets, sums = self.parts[0]
            yield [strings(text, offsets), *(pa.array(s.astype(np.int64)) for s in sums)]
        self.parts, self.held = [], 0
