"""Elias-Fano coded sequences and the n-gram trie made of them, queried for many n-grams at once."""

from __future__ import annotations

import tempfile

import numpy as np
import pandas as pd

#: Place of the k-th set bit in a byte, at 8 * byte + k.
_BIT = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[:8] for b in range(256)], np.int64).ravel()
#: Numbers looked up at a time.
PART = 1 << 15
_EACH_2, _EACH_4, _EACH_8 = np.uint64(0x5555555555555555), np.uint64(0x3333333333333333), np.uint64(0x0F0F0F0F0F0F0F0F)
_OCTETS, _TOPS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)


class EliasFano:
    """A rising sequence of whole numbers from 0: high parts as unary gaps in a bit vector, low parts packed.

    Beside the bits lies the number of ones before each 64-bit word, so that nothing is unpacked or counted to
    read from it.
    """

    def __init__(self, n: int, low_bits: int, high: np.ndarray, ones: np.ndarray, low: np.ndarray) -> None:
        self.n, self.low_bits, self.high, self.ones, self.low = n, low_bits, high, ones, low
        self._zeros = None
        #: The low parts as numbers that start at any byte.
        self._octets = np.ndarray((max(0, low.nbytes - 7),), np.uint64, low, strides=(1,))

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = min(56, max(0, ((top + 1) // n).bit_length() - 1)) if n else 0
        bits = np.zeros(-(-(n + (top >> low_bits) + 2) // 64) * 64, np.uint8)
        bits[(values >> low_bits) + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = np.cumsum(np.bitwise_count(high), dtype=np.int64) - np.bitwise_count(high)
        each = ((values[:, None] >> np.arange(low_bits)) & 1).astype(np.uint8).ravel()
        packed = np.packbits(each, bitorder="little")
        low = np.zeros(len(packed) // 8 + 2, np.uint64)
        low.view(np.uint8)[: len(packed)] = packed
        return cls(n, low_bits, high, ones.astype(np.uint32), low)

    def _select(self, word: np.ndarray, rest: np.ndarray, flip: bool) -> np.ndarray:
        """Place of the ``rest``-th one (zero, if ``flip``) of the words numbered ``word``."""
        held = ~self.high[word] if flip else self.high[word]
        # ones up to each octet, all eight at once
        pairs = held - ((held >> np.uint64(1)) & _EACH_2)
        fours = (pairs & _EACH_4) + ((pairs >> np.uint64(2)) & _EACH_4)
        upto = ((fours + (fours >> np.uint64(4))) & _EACH_8) * _OCTETS
        rest = rest.astype(np.uint64)
        octet = np.bitwise_count((((rest * _OCTETS) | _TOPS) - upto) & _TOPS).astype(np.uint64) << np.uint64(3)
        before = ((upto << np.uint64(8)) >> octet) & np.uint64(255)
        return word * 64 + octet.astype(np.int64) + _BIT[((held >> octet) & np.uint64(255)) << np.uint64(3) | (rest - before)]

    def _select_one(self, i: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, i.astype(np.uint32), "right") - 1
        return self._select(word, i - self.ones[word].astype(np.int64), False)

    def _before_bucket(self, high: np.ndarray) -> np.ndarray:
        """How many values have a high part below ``high``."""
        at = np.maximum(high - 1, 0)
        if self._zeros is None:
            self._zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        zeros = self._zeros
        at = np.minimum(at, len(self.high) * 64 - self.n - 1)
        word = np.searchsorted(zeros, at, "right") - 1
        return np.where(high > 0, self._select(word, at - zeros[word], True) - at, 0)

    def _bucket_end(self, first: np.ndarray, high: np.ndarray) -> np.ndarray:
        """``first`` and how many values share the high part: the ones that follow in the bit vector."""
        at = first + high
        inside = at < len(self.high) * 64
        word = np.where(inside, at, 0) >> 6
        rest = self.high[word] >> (at & 63).astype(np.uint64)
        run = np.bitwise_count(rest & ~(rest + np.uint64(1))).astype(np.int64)
        end = first + np.where(inside, run, 0)
        over = np.flatnonzero(inside & (run == 64 - (at & 63)))
        end[over] = self._before_bucket(high[over] + 1)
        return end

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.int64)
        bit = i * self.low_bits
        held = self._octets[bit >> 3] >> (bit & 7).astype(np.uint64)
        return (held & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def at(self, i: np.ndarray) -> np.ndarray:
        """The values at places ``i``."""
        i = np.asarray(i, np.int64)
        if not len(i):
            return i
        return ((self._select_one(i) - i) << self.low_bits) | self._low(i)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of the successor of each ``x``, the first value not below it, where it is ``x`` itself; else -1."""
        x = np.asarray(x, np.int64)
        if not self.n or not len(x):
            return np.full(len(x), -1, np.int64)
        # a part at a time stays in the processor's cache
        return np.concatenate([self._find(x[i: i + PART]) for i in range(0, len(x), PART)])

    def _find(self, x: np.ndarray) -> np.ndarray:
        high, low = x >> self.low_bits, x & ((1 << self.low_bits) - 1)
        first = self._before_bucket(high)
        end = self._bucket_end(first, high)
        found = np.full(len(x), -1, np.int64)
        asked = np.flatnonzero(first < end)
        left, right, low = first[asked], end[asked], low[asked]
        while len(asked):
            middle = (left + right) >> 1
            held = self._low(middle)
            hit = held == low
            found[asked[hit]] = middle[hit]
            below = held < low
            left, right = np.where(below, middle + 1, left), np.where(below, right, middle)
            on = ~hit & (left < right)
            asked, left, right, low = asked[on], left[on], right[on], low[on]
        return found

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], np.int64), self.high, self.ones, self.low]

    @classmethod
    def from_arrays(cls, head: np.ndarray, high: np.ndarray, ones: np.ndarray, low: np.ndarray) -> EliasFano:
        return cls(int(head[0]), int(head[1]), high, ones, low)


class Level:
    """Sorted members of numbered groups, as one Elias-Fano sequence beside one of pointers.

    Within a group members start anew, so each group is raised by what the sequence has reached before it; a
    member is found by a successor search for its value relative to that.
    """

    def __init__(self, pointers: EliasFano, members: EliasFano) -> None:
        self.pointers, self.members = pointers, members

    @classmethod
    def of(cls, group: np.ndarray, member: np.ndarray, groups: int) -> Level:
        """``group`` and within it ``member`` rise."""
        ends = np.searchsorted(group, np.arange(groups + 1))
        last = np.where(ends[1:] > ends[:-1], member[np.maximum(ends[1:] - 1, 0)] + 1 if len(member) else 0, 0)
        raised = np.cumsum(last) - last
        return cls(EliasFano.of(ends), EliasFano.of(member + raised[group]))

    def first(self, group: np.ndarray) -> np.ndarray:
        return self.pointers.at(group)

    def find(self, group: np.ndarray, member: np.ndarray) -> np.ndarray:
        """Place of each member in its group, or -1; ``group`` -1 has no members."""
        found = np.full(len(group), -1, np.int64)
        ask = np.flatnonzero((group >= 0) & (member >= 0))
        if not len(ask) or not self.members.n:
            return found
        # where the groups asked for begin and end, and what their members are raised by
        edge = np.zeros(self.pointers.n, bool)
        edge[group[ask]] = edge[group[ask] + 1] = True
        pointer = self.pointers.at(np.flatnonzero(edge))
        raised = np.where(pointer > 0, self.members.at(np.maximum(pointer - 1, 0)) + 1, 0)
        back = (np.cumsum(edge) - 1)[group[ask]]
        value, top = raised[back] + member[ask], raised[back + 1] - 1
        inside = np.flatnonzero(value <= top)
        found[ask[inside]] = self.members.find(value[inside])
        return found


def quantised(values: np.ndarray, bits: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """``(codebook, codes)`` of positive values: themselves if few differ, else means of bins of equal width in logarithms."""
    distinct, place = np.unique(values, return_inverse=True)
    if len(distinct) > 1 << bits:
        log = np.log(distinct)
        bin_of = np.minimum(((log - log[0]) / (log[-1] - log[0]) * (1 << bits)).astype(np.int64), (1 << bits) - 1)
        place = bin_of[place]
        often = np.bincount(place, minlength=1 << bits)
        distinct = np.bincount(place, weights=values, minlength=1 << bits) / np.maximum(often, 1)
    return distinct, place.astype(np.uint8 if bits <= 8 else np.uint16)


class Trie:
    """Trigrams by their middle word, then first and last word, with quantised smoothed probabilities.

    Levels: words; middle words; last words after a middle word; first words before it; and the last words
    of each pair, by their place among those that follow the middle word in any context.
    """

    def __init__(self, words: EliasFano, middles: EliasFano, after: Level, before: Level, last: Level, codes: list[np.ndarray]) -> None:
        self.words, self.middles, self.after, self.before, self.last, self.codes = words, middles, after, before, last, codes

    def parts(self) -> list[np.ndarray]:
        found = [*self.words.arrays(), *self.middles.arrays()]
        for level in (self.after, self.before, self.last):
            found += [*level.pointers.arrays(), *level.members.arrays()]
        return found + self.codes

    def write(self, file) -> list[tuple]:
        """Writes all levels to an open file and returns where they lie."""
        where = []
        for part in self.parts():
            file.write(b"\0" * (-file.tell() % 8))
            where.append((part.dtype.str, len(part), file.tell()))
            file.write(part.tobytes())
        file.flush()
        return where

    @classmethod
    def mapped(cls, file, where: list[tuple]) -> Trie:
        """The trie in a file, mapped into memory: only pages that a query touches are read."""
        parts = [np.memmap(file, np.dtype(d), "r", at, (n,)).view(np.ndarray) if n else np.zeros(0, d) for d, n, at in where]
        coded = [EliasFano.from_arrays(*parts[i: i + 4]) for i in range(0, 32, 4)]
        levels = [Level(*coded[i: i + 2]) for i in (2, 4, 6)]
        return cls(coded[0], coded[1], *levels, parts[32:])

    def probability(self, ids: np.ndarray, first: np.ndarray, middle: np.ndarray, last: np.ndarray, single: np.ndarray) -> np.ndarray:
        """P(last | first middle), words given by their place in ``ids``; ``single`` is P(last) without context."""
        word = self.words.find(ids)
        first, last = word[first], word[last]
        group = np.where(word >= 0, self.middles.find(np.maximum(word, 0)), -1)[middle]
        after, before = self.after.find(group, last), self.before.find(group, first)
        both = np.flatnonzero((after >= 0) & (before >= 0))
        place = after[both] - self.after.first(group[both])
        whole = self.last.find(before[both], place)
        p2_book, p2, b2_book, b2, p3_book, p3, b3_book, b3 = self.codes
        lower = single.astype(float)
        known = group >= 0
        if known.any():
            lower[known] *= b2_book[b2[group[known]]]
            seen = after >= 0
            lower[seen] += p2_book[p2[after[seen]]]
            met = before >= 0
            lower[met] *= b3_book[b3[before[met]]]
            lower[both[whole >= 0]] += p3_book[p3[whole[whole >= 0]]]
        return lower


def places(*columns: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct numbers of all columns in order, and each column as places among them."""
    code, ids = pd.factorize(np.concatenate(columns))
    order = np.argsort(ids)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return ids[order], np.split(place[code], np.cumsum([len(c) for c in columns])[:-1])


def _renumbered(held: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    """Columns of numbers as places among the numbers marked in ``held``."""
    place = np.cumsum(held) - 1
    return [place[c] for c in columns]


def build(ids: np.ndarray, first: np.ndarray, middle: np.ndarray, last: np.ndarray, spread: np.ndarray, discount: float) -> Trie:
    """The trie of the trigrams given, one entry for each occurrence, words by their place in ``ids``, which rise.

    Absolute discounting: ``discount`` of each seen n-gram's count goes to the next shorter context.
    Rows of ``spread`` are (middle, first or -1, occurrences, kinds) of what follows contexts that are spread over several
    tries; they stand instead of this trie's own numbers, and such a context is known even if nothing here follows it.
    """
    of, by, n, kinds = spread.reshape(-1, 4).T
    paired = by >= 0
    of, by = np.searchsorted(ids, of), np.searchsorted(ids, by[paired])
    used, inner = np.zeros(len(ids), bool), np.zeros(len(ids), bool)
    for x in (first, middle, last, of, by):
        used[x] = True
    inner[middle] = inner[of] = True
    words = ids[used]
    group, of_group = _renumbered(inner, middle, of)
    first, last, by, middles = _renumbered(used, first, last, by, np.flatnonzero(inner))

    after_key, after_of, after_n = np.unique(group << 32 | last, return_inverse=True, return_counts=True)
    own = of_group[paired] << 32 | by
    before_key, before_of = np.unique(np.concatenate([group << 32 | first, own]), return_inverse=True)
    before_of = before_of[: len(group)]
    after_group, before_group = after_key >> 32, before_key >> 32
    after = Level.of(after_group, after_key & 0xFFFFFFFF, len(middles))
    before = Level.of(before_group, before_key & 0xFFFFFFFF, len(middles))
    start = np.searchsorted(after_group, np.arange(len(middles)))
    whole_key, whole_n = np.unique(before_of.astype(np.int64) << 32 | (after_of - start[group]), return_counts=True)
    context = whole_key >> 32
    last_level = Level.of(context, whole_key & 0xFFFFFFFF, len(before_key))

    n2, kinds2 = np.bincount(group, minlength=len(middles)), np.bincount(after_group, minlength=len(middles))
    n3, kinds3 = np.bincount(before_of, minlength=len(before_key)), np.bincount(context, minlength=len(before_key))
    n2[of_group[~paired]], kinds2[of_group[~paired]] = n[~paired], kinds[~paired]
    place = np.searchsorted(before_key, own)
    n3[place], kinds3[place] = n[paired], kinds[paired]
    codes = [
        *quantised((after_n - discount) / n2[after_group]), *quantised(discount * kinds2 / n2),
        *quantised((whole_n - discount) / n3[context]), *quantised(discount * kinds3 / n3),
    ]
    return Trie(EliasFano.of(words), EliasFano.of(middles), after, before, last_level, codes)


def mapped(trie: Trie) -> Trie:
    """The trie written to a temporary file and mapped from there; the file goes with the mapping."""
    file = tempfile.TemporaryFile()
    return Trie.mapped(file, trie.write(file))
