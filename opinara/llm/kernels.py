"""Vectorised passes over the UTF-8 bytes of many texts at once.

Arrow hands a batch's texts over as one run of bytes with offsets; they are worked through in slabs
of a quarter of a megabyte, so that the arrays of one slab bound the memory of a task. A text larger
than a slab is a slab of its own, which ``windows`` and ``blank_cuts`` take apart again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLAB_BYTES = 1 << 18
# An odd multiplier, its inverse modulo 2^64, and finalizer constants.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BEGIN, END = 0x110000, 0x110001  # marks of a word, past the last code point
FIRST, SECOND = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


@dataclass(frozen=True)
class Slab:
    """Rows ``first`` to ``first + len(offsets) - 1`` of a batch; text i is data[offsets[i]:offsets[i+1]]."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a column of texts without nulls; text i is data[offsets[i]:offsets[i+1]]."""
    column = column.cast(pa.large_string())
    count = len(column)
    _, places, values = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + count + 1] if count else np.zeros(1, np.int64)
    return offsets, np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)


def slabs(column: pa.Array, limit: int = SLAB_BYTES) -> Iterator[Slab]:
    count = len(column)
    offsets, data = bytes_of(column)
    first = 0
    while first < count:
        last = max(int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1, first + 1)
        start, stop = offsets[first], offsets[last]
        yield Slab(first, data[start:stop], offsets[first : last + 1] - start)
        first = last


def windows(slab: Slab, margin: int, limit: int = SLAB_BYTES) -> Iterator[tuple[Slab, int, int, int]]:
    """The slab, or windows of its one long text: window, where it begins, and the bounds of its own part.

    The own parts cover the text once; ``margin`` bytes to each side are there to look at.
    """
    size = len(slab.data)
    if len(slab) > 1 or size <= limit + margin:
        yield slab, 0, 0, size
        return
    for start in range(0, size, limit):
        low, high = max(start - margin, 0), min(start + limit + margin, size)
        yield Slab(slab.first, slab.data[low:high], np.array([0, high - low])), low, start - low, min(start + limit, size) - low


def blank_cuts(slab: Slab, limit: int = SLAB_BYTES) -> Iterator[Slab]:
    """The slab, or parts of its one long text, cut at blanks: no word is in two of them."""
    size, start = len(slab.data), 0
    while len(slab) == 1 and size - start > limit:
        stop = start + limit
        while stop < size and not len(blanks := np.flatnonzero(BLANK[slab.data[stop : stop + limit]])):
            stop += limit
        stop = min(stop + int(blanks[0]) + 1, size) if stop < size else size
        yield Slab(slab.first, slab.data[start:stop], np.array([0, stop - start]))
        start = stop
    if start == 0:
        yield slab
    elif start < size:
        yield Slab(slab.first, slab.data[start:], np.array([0, size - start]))


def mix(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    values = values ^ (values >> np.uint64(33))
    values = values * FIRST
    values ^= values >> np.uint64(33)
    values *= SECOND
    values ^= values >> np.uint64(33)
    return values


def letters(seed: int) -> np.ndarray:
    """A random odd-looking 64-bit value for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * BASE + np.uint64(seed * 2 + 1))


_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i for i below ``count``."""
    global _powers
    if len(_powers[0]) < count:
        size = max(count, 2 * len(_powers[0]))
        steps = []
        for factor in (BASE, BASE_INVERSE):
            row = np.full(size, factor, np.uint64)
            row[0] = 1
            steps.append(np.multiply.accumulate(row))
        _powers = tuple(steps)
    return _powers[0][:count], _powers[1][:count]


def prefix_hash(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Running sums from which ``span_hash`` reads the hash of any span."""
    up, _ = powers(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values[data] * up[:-1], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end]; equal bytes give equal hashes wherever they stand."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * FIRST)


# Words are runs without these bytes: blank, and tab to carriage return.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


@dataclass(frozen=True)
class Words:
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray  # row of the slab


def words(slab: Slab) -> Words:
    solid = ~BLANK[slab.data]
    edges = slab.offsets[:-1][np.diff(slab.offsets) > 0]  # where a text begins
    before = np.zeros(len(solid), bool)
    before[1:] = solid[:-1]
    before[edges] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.zeros(len(solid), bool)
    after[:-1] = solid[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(solid & ~after) + 1
    return Words(starts, ends, np.searchsorted(slab.offsets, starts, "right") - 1)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of ``size`` hashes, in order."""
    count = max(len(hashes) - size + 1, 0)
    total = np.zeros(count, np.uint64)
    for place in range(size):
        total = mix(total * BASE + hashes[place : place + count])
    return total


@dataclass(frozen=True)
class WordGrams:
    """Words as one array of code points with marks, and the hash of every n-gram ending at each place."""

    step: np.ndarray  # place within its word; 0 is the begin mark
    owner: np.ndarray  # which word
    hashes: list[np.ndarray]  # by order; order 0 is the empty context


def word_grams(words: list[str], salts: np.ndarray, order: int) -> WordGrams:
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    codes = np.empty(int(sizes.sum()), np.uint64)
    inner = np.ones(len(codes), bool)
    inner[starts] = inner[starts + sizes - 1] = False
    codes[inner] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes[starts], codes[starts + sizes - 1] = BEGIN, END
    owner = np.repeat(np.arange(len(words)), sizes)
    step = np.arange(len(codes)) - starts[owner]
    own = salts[owner]
    hashes, total = [mix(own)], own.copy()
    for n in range(1, order + 1):
        moved = np.zeros_like(codes)
        moved[n - 1 :] = codes[: len(codes) - n + 1]
        total = total + mix((moved + np.uint64(1)) * np.uint64(2 * n + 1))
        hashes.append(mix(total + np.uint64(n)))
    return WordGrams(step, owner, hashes)


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
