"""A bidirectional FM-index over a delimited vocabulary, and the search for words one edit away.

The vocabulary is one text, each word between delimiters. Two indexes, over the text and over its
reverse, keep the same set of occurrences as an interval of ranks among sorted suffixes each; a letter on
either side narrows one interval by ranks and the other by the count of smaller letters. Ranks come from
a wavelet matrix. All queries go step by step at once, as numpy arrays.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DELIMITER, UNKNOWN = 0, -1


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """By doubling, from the eight codes (below 128 each, else fewer) that fit a key at first."""
    size = len(codes)
    bits = max(int(codes.max()).bit_length(), 1) if size else 1
    step = max(63 // bits, 1)
    rank = np.zeros(size, np.int64)
    for place in range(step):
        rank <<= bits
        rank[: max(size - place, 0)] |= codes[place:]
    while True:
        order = np.argsort(rank, kind="stable")
        sorted_ = rank[order]
        new = np.cumsum(np.concatenate([[0], sorted_[1:] != sorted_[:-1]])) if size else sorted_
        rank[order] = new
        if not size or new[-1] == size - 1:
            break
        # A suffix that ends before sorts first.
        behind = np.zeros(size, np.int64)
        behind[: max(size - step, 0)] = rank[step:] + 1
        rank = rank * (size + 1) + behind
        step *= 2
    return order


class Ranks:
    """Wavelet matrix: in a span of places, how often a letter occurs, and how many are smaller."""

    def __init__(self, letters: np.ndarray, size: int):
        self.bits = max((size - 1).bit_length(), 1)
        self.zeros, self.upto = [], []
        current = letters
        for bit in range(self.bits - 1, -1, -1):
            zero = (current >> bit) & 1 == 0
            upto = np.zeros(len(current) + 1, np.int32)
            np.cumsum(zero, out=upto[1:])
            self.upto.append(upto)
            self.zeros.append(int(upto[-1]))
            current = np.concatenate([current[zero], current[~zero]])
        every = np.arange(size)
        self.base, _, _ = self._down(np.zeros(size, np.int64), np.full(size, len(letters)), every)

    def _down(self, lo: np.ndarray, hi: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        less = np.zeros(len(lo), np.int64)
        for level, (zeros, upto) in enumerate(zip(self.zeros, self.upto)):
            a, b = upto[lo], upto[hi]
            one = (letter >> (self.bits - 1 - level)) & 1 == 1
            less += np.where(one, b - a, 0)
            lo = np.where(one, zeros + lo - a, a)
            hi = np.where(one, zeros + hi - b, b)
        return lo, hi, less

    def within(self, lo: np.ndarray, width: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Occurrences before ``lo``, in the span, and of smaller letters in the span."""
        low, high, less = self._down(lo, lo + width, letter)
        return low - self.base[letter], high - low, less


class Side:
    """Of one text: letters before the sorted suffixes, their ranks, and where each suffix starts."""

    def __init__(self, codes: np.ndarray, size: int):
        self.places = suffix_array(codes)
        self.letters = codes[self.places - 1]
        self.ranks = Ranks(self.letters, size)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=size))])[:size]

    def grown(self, lo: np.ndarray, width: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The interval with one more letter in front, and by how much that of the reverse moves on."""
        known = np.maximum(letter, 0)
        before, count, less = self.ranks.within(lo, width, known)
        return self.first[known] + before, np.where(letter == UNKNOWN, 0, count), less


@dataclass
class Words:
    """Words as codes, one after the other."""

    codes: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    def reversed(self) -> "Words":
        ends = self.starts + self.sizes
        owner = np.repeat(np.arange(len(self.starts)), self.sizes)
        at = np.arange(len(self.codes)) - self.starts[owner]
        return Words(self.codes[ends[owner] - 1 - at], self.starts, self.sizes)

    def letter(self, word: np.ndarray, place: np.ndarray) -> np.ndarray:
        """At ``place``, or the delimiter right behind a word."""
        inside = place < self.sizes[word]
        if not len(self.codes):
            return np.full(len(word), DELIMITER)
        return np.where(inside, self.codes[np.minimum(self.starts[word] + place, len(self.codes) - 1)], DELIMITER)


class Index:
    """Both sides of the vocabulary's text. ``words`` are distinct."""

    def __init__(self, words: list[str]):
        points = [np.frombuffer(w.encode("utf-32-le"), np.uint32) for w in words]
        flat = np.concatenate(points) if points else np.zeros(0, np.uint32)
        self.alphabet = np.unique(flat)
        self.size = len(self.alphabet) + 1
        sizes = np.array(list(map(len, points)), np.int64)
        self.starts = np.cumsum(sizes + 1) - sizes  # in the text, behind the delimiter
        text = np.zeros(int(sizes.sum()) + len(words) + 1, np.int64)
        inner = np.ones(len(text), bool)
        inner[0] = False
        inner[self.starts + sizes] = False
        text[inner] = np.searchsorted(self.alphabet, flat) + 1
        self.length = len(text)
        self.ends = self.starts + sizes
        self.text, self.back = Side(text, self.size), Side(text[::-1].copy(), self.size)

    def queries(self, words: list[str]) -> Words:
        sizes = np.array(list(map(len, words)), np.int64)
        flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        at = np.minimum(np.searchsorted(self.alphabet, flat), max(len(self.alphabet) - 1, 0))
        known = self.alphabet[at] == flat if len(self.alphabet) else np.zeros(len(flat), bool)
        return Words(np.where(known, at + 1, UNKNOWN), np.cumsum(sizes) - sizes, sizes)

    def one_edit(self, words: list[str], front: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, vocabulary word): the first half agrees (``front``) or the last, one edit in the other.

        A word of ``n`` letters has a first half of ``n // 2``.
        """
        asked = self.queries(words)
        if front:
            query, place = _search(self.text, self.back, asked, asked.sizes // 2, self.length)
            # Places are of the reverse, where a word's end comes first.
            order = np.argsort(-self.ends)
            word = order[np.searchsorted(self.length - 1 - self.ends[order], place, "right") - 1]
        else:
            query, place = _search(self.back, self.text, asked.reversed(), asked.sizes - asked.sizes // 2, self.length)
            word = np.searchsorted(self.starts - 1, place, "right") - 1
        pairs = np.unique(query * np.int64(len(self.starts) + 1) + word)
        return pairs // (len(self.starts) + 1), pairs % (len(self.starts) + 1)


def _exact(left: Side, words: Words, half: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The other side's interval of each word's first ``half`` letters behind a delimiter, from the middle to the left."""
    count = len(half)
    lo, other, width = np.zeros(count, np.int64), np.zeros(count, np.int64), np.full(count, length)
    for step in range(int(half.max(initial=-1)) + 2):
        live = np.flatnonzero((step <= half) & (width > 0))
        if not len(live):
            break
        place = half[live] - 1 - step
        letter = np.where(place >= 0, words.letter(live, np.maximum(place, 0)), DELIMITER)
        found, size, less = left.grown(lo[live], width[live], letter)
        lo[live], width[live] = found, size
        other[live] += less
    return other, width


def _symbols(side: Side, lo: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each interval the letters that can follow, as (interval, letter, occurrences), sorted."""
    owner = np.repeat(np.arange(len(lo)), width)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(width) - width, width) + np.repeat(lo, width)
    size = len(side.first)
    both, count = np.unique(owner * np.int64(size) + side.letters[at], return_counts=True)
    return both // size, both % size, count


def _search(left: Side, right: Side, words: Words, half: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (word, place in ``right`` of a match with one edit behind the first ``half``)."""
    # Words of one beginning share their way up to where they part.
    heads, head_of, first = {}, np.empty(len(half), np.int64), []
    for number, (start, size) in enumerate(zip(words.starts.tolist(), half.tolist())):
        name = (size, words.codes[start : start + size].tobytes())
        head_of[number] = heads.setdefault(name, len(heads))
        if len(heads) > len(first):
            first.append(number)
    first = np.array(first, np.int64)
    lo, width = _exact(left, Words(words.codes, words.starts[first], words.sizes[first]), half[first], length)
    # Ways without an edit: nodes, and which words are at each.
    alive = np.flatnonzero(width[head_of] > 0)
    node = head_of[alive]
    used, node = np.unique(node, return_inverse=True)
    lo, width = lo[used], width[used]
    # Ways with one edit: word and interval.
    none = np.zeros(0, np.int64)
    edited, edited_lo, edited_width = none, none, none
    found_word, found_place = [none], [none]
    step = 0
    while len(alive) or len(edited):
        letter = words.letter(alive, half[alive] + step)
        over = half[alive] + step == words.sizes[alive]
        owner, symbol, count = _symbols(right, lo, width)
        before, _, _ = right.ranks.within(lo[owner], width[owner], symbol)
        grown = right.first[symbol] + before
        # Each word meets the letters after its node.
        bounds = np.searchsorted(owner, np.arange(len(lo) + 1))
        times = bounds[node + 1] - bounds[node]
        who = np.repeat(np.arange(len(alive)), times)
        entry = np.arange(len(who)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(bounds[node], times)
        other = (symbol[entry] != DELIMITER) & (symbol[entry] != letter[who])
        who_other, entry_other = who[other], entry[other]
        # One letter more: the next letter of the word is still to come.
        now = np.concatenate([edited, alive[who_other]])
        now_lo = np.concatenate([edited_lo, grown[entry_other]])
        now_width = np.concatenate([edited_width, count[entry_other]])
        wanted = words.letter(now, half[now] + step)
        ended = half[now] + step == words.sizes[now]
        at, size, _ = right.grown(now_lo, now_width, wanted)
        hit = size > 0
        done = hit & ended
        found_word.append(now[done])
        # The match ends with a delimiter; its suffix starts where the word's own delimiter does.
        found_place.append(right.places[at[done]])
        on = hit & ~ended
        # Another letter instead, or one letter less.
        instead = ~over[who_other]
        less = ~over
        edited = np.concatenate([now[on], alive[who_other[instead]], alive[less]])
        edited_lo = np.concatenate([at[on], grown[entry_other[instead]], lo[node[less]]])
        edited_width = np.concatenate([size[on], count[entry_other[instead]], width[node[less]]])
        # No edit so far.
        key = owner * np.int64(len(right.first)) + symbol
        wanted = node * np.int64(len(right.first)) + np.maximum(letter, 0)
        place = np.minimum(np.searchsorted(key, wanted), max(len(key) - 1, 0))
        stays = ~over & (letter > DELIMITER)
        stays &= key[place] == wanted if len(key) else False
        alive, place = alive[stays], place[stays]
        used, node = np.unique(place, return_inverse=True)
        lo, width = grown[used], count[used]
        step += 1
    return np.concatenate(found_word), np.concatenate(found_place)
