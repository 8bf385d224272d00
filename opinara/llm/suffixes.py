"""Suffix arrays by two-stage sorting, in vectorised passes over one piece of text.

A suffix is small if it is smaller than the one that follows it. Only small suffixes are sorted
directly. All others are induced: scanning the order from the front, each suffix puts its predecessor,
if that is not small, at the front of the predecessor's bucket of first bytes.
"""

from __future__ import annotations

import numpy as np


def small_suffixes(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; the last one is not."""
    count = len(text)
    small = np.zeros(count, bool)
    if count > 1:
        # Equal neighbours are decided by the first pair further on that differs.
        differs = np.where(text[:-1] != text[1:], np.arange(count - 1), count - 1)
        decided = np.minimum.accumulate(differs[::-1])[::-1]
        known = decided < count - 1
        small[:-1][known] = text[decided[known]] < text[decided[known] + 1]
    return small


def words_at(padded: np.ndarray, count: int, kind: str) -> np.ndarray:
    """The big-endian number that begins at each byte, a view that needs no copy."""
    return np.ndarray((count,), kind, padded.data, strides=(1,))


def block_ranks(padded: np.ndarray) -> np.ndarray:
    """The rank of the 16 bytes at each place among all such blocks: bigger steps for the sort."""
    words = words_at(padded, len(padded) - 7, ">u8").astype(np.uint64)
    ranks = np.unique(words, return_inverse=True)[1].astype(np.uint64)
    return np.unique((ranks[:-8] << np.uint64(32)) | ranks[8:], return_inverse=True)[1].astype(np.uint64)


def sort_directly(places: np.ndarray, padded: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes; only ties go on to the next bytes."""
    keys = block_ranks(padded)
    order = places.copy()
    # Of the suffixes still tied: where they stand in the order, which they are, and their group.
    slot, tied, group = np.arange(len(order)), places, np.zeros(len(order), np.uint64)
    for offset in range(0, depth, 16):
        composite = (group << np.uint64(32)) | keys[tied + offset]
        turn = np.argsort(composite, kind="stable")
        composite, tied = composite[turn], tied[turn]
        order[slot] = tied
        first = np.ones(len(composite), bool)
        first[1:] = composite[1:] != composite[:-1]
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(composite)))
        stay = np.repeat(sizes > 1, sizes)
        # Members of a group stand side by side, so a group's number is where it starts.
        group = np.repeat(slot[starts], sizes)[stay].astype(np.uint64)
        slot, tied = slot[stay], tied[stay]
        if not len(tied):
            break
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes in the order of at least their first ``depth`` bytes."""
    count = len(text)
    padded = np.concatenate([text, np.zeros(depth + 32, np.uint8)])
    small = small_suffixes(text)
    sorted_small = sort_directly(np.flatnonzero(small), padded, depth)
    sizes = np.bincount(text, minlength=256)
    of_small = np.bincount(text[sorted_small], minlength=256)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    small_starts = np.concatenate([[0], np.cumsum(of_small)])
    order = np.empty(count, np.int64)
    front = starts.copy()  # next free place for an induced suffix in each bucket
    if count:
        order[front[text[-1]]] = count - 1  # follows from the empty suffix, which is the smallest
        front[text[-1]] += 1
    for byte in np.flatnonzero(sizes):
        done = starts[byte]
        # A run of one byte induces within its own bucket, a step per round.
        while done < front[byte]:
            before = order[done : front[byte]] - 1
            done = front[byte]
            before = before[before >= 0]
            before = before[(text[before] == byte) & ~small[before]]
            order[done : done + len(before)] = before
            front[byte] += len(before)
        own = sorted_small[small_starts[byte] : small_starts[byte + 1]]
        order[front[byte] : front[byte] + len(own)] = own
        before = order[starts[byte] : starts[byte] + sizes[byte]] - 1
        before = before[before >= 0]
        before = before[(text[before] > byte)]  # a larger first byte: never small
        heads = text[before]
        turn = np.argsort(heads, kind="stable")
        before, heads = before[turn], heads[turn]
        buckets, at, amounts = np.unique(heads, return_index=True, return_counts=True)
        offset = np.arange(len(before)) - np.repeat(at, amounts)
        order[np.repeat(front[buckets], amounts) + offset] = before
        front[buckets] += amounts
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, cap: int) -> np.ndarray:
    """Bytes, ``cap`` or up to seven more at most, that each listed suffix shares with the one before it."""
    padded = np.concatenate([text, np.zeros(cap + 16, np.uint8)])
    keys = words_at(padded, len(padded) - 7, "<u8").astype(np.uint64)
    shared = np.zeros(len(order), np.int64)
    active = np.arange(1, len(order))
    one, two = order[1:], order[:-1]
    for offset in range(0, cap, 8):
        differ = keys[one + offset] ^ keys[two + offset]
        same = differ == 0
        ends = differ[~same]
        # The lowest byte that differs is the first.
        shared[active[~same]] = offset + sum(((ends & np.uint64((1 << 8 * b) - 1)) == 0).astype(np.int64) for b in range(1, 8))
        active, one, two = active[same], one[same], two[same]
        shared[active] = offset + 8
    if len(order) > 1:
        shared[1:] = np.minimum(shared[1:], len(text) - np.maximum(order[1:], order[:-1]))
    return shared
