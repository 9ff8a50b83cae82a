"""Words of whole batches of texts as arrays: what is known of them is looked up for all at once."""

from __future__ import annotations

import numpy as np


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start .. start + size - 1 of each range, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class WordTable:
    """Lists of integers for words of at most SIZE bytes, found for many words at once by their bytes and number."""

    SIZE = 15

    def __init__(self, room: int):
        self.room = room
        bits = max(10, (2 * room - 1).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._low, self._high, self._word = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        self.clear()

    def clear(self) -> None:
        self._word.fill(-1)
        self.count, self.first, self.ids = 0, np.zeros(1, np.int64), np.zeros(1 << 16, np.int32)

    @staticmethod
    def keys(data: bytes, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two integers for each word that hold all its bytes and their number; data needs 16 bytes behind the last."""
        raw = np.frombuffer(data, np.uint8)
        wide = np.ndarray((len(raw) - 7,), "<u8", data, strides=(1,))
        # the low bytes of a word of so many
        masks = np.array([(1 << 8 * min(k, 8)) - 1 for k in range(16)], np.uint64)
        low = wide[at] & masks[sizes]
        high = wide[at + 8] & masks[np.maximum(sizes - 8, 0)] | sizes.astype(np.uint64) << np.uint64(56)
        return low, high

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        x = (low ^ high * np.uint64(0xBF58476D1CE4E5B9)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        return (x * np.uint64(0x94D049BB133111EB) >> self._shift).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The number of each word, -1 if unknown."""
        slots = self._slot(low, high)
        out = self._word[slots]
        todo = np.flatnonzero((out >= 0) & ((self._low[slots] != low) | (self._high[slots] != high)))
        slots = slots[todo]
        while len(todo):
            slots = (slots + 1) & self._mask
            found = self._word[slots]
            out[todo] = found
            on = (found >= 0) & ((self._low[slots] != low[todo]) | (self._high[slots] != high[todo]))
            todo, slots = todo[on], slots[on]
        return out

    def add(self, low: np.ndarray, high: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The numbers of distinct unknown words, which are known from now on."""
        numbers = np.arange(self.count, self.count + len(low), dtype=np.int32)
        used = int(self.first[-1])
        while used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.int32)])
        self.ids[used : used + len(ids)] = ids
        self.first = np.concatenate([self.first, used + np.cumsum(sizes)])
        self.count += len(low)
        slots, todo = self._slot(low, high), np.arange(len(low))
        while len(todo):
            free = self._word[slots] < 0
            self._word[slots[free]] = numbers[todo[free]]  # of several for one slot the last stays
            won = free & (self._word[slots] == numbers[todo])
            self._low[slots[won]], self._high[slots[won]] = low[todo[won]], high[todo[won]]
            todo, slots = todo[~won], (slots[~won] + 1) & self._mask
        return numbers

    def lists(self, data: bytes, at: np.ndarray, sizes: np.ndarray, learn) -> tuple[np.ndarray, np.ndarray]:
        """(integers of all words in a row, how many each word has), for as many words as the table has room for at most.

        Words stand in data at the given places. learn(at, sizes) makes the same of words that aren't known; those of
        more than SIZE bytes are never remembered.
        """
        short, far = np.flatnonzero(sizes <= self.SIZE), np.flatnonzero(sizes > self.SIZE)
        low, high = self.keys(data, at[short], sizes[short])
        number = self.find(low, high)
        new = np.flatnonzero(number < 0)
        if len(new):
            distinct = lambda order: np.concatenate([[True], (low[order[1:]] != low[order[:-1]]) | (high[order[1:]] != high[order[:-1]])])
            order = new[np.lexsort((high[new], low[new]))]
            first = distinct(order)
            if self.count + int(first.sum()) > self.room:  # all start anew
                self.clear()
                order = np.lexsort((high, low))
                first = distinct(order)
            one = order[first]
            number[order] = self.add(low[one], high[one], *learn(at[short[one]], sizes[short[one]]))[np.cumsum(first) - 1]
        counts = np.zeros(len(at), np.int64)
        begin = self.first[number]
        counts[short] = self.first[number + 1] - begin
        if not len(far):
            return self.ids[ranges(begin, counts)], counts
        more, counts[far] = learn(at[far], sizes[far])
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]), np.int32)
        out[ranges((ends - counts)[short], counts[short])] = self.ids[ranges(begin, counts[short])]
        out[ranges((ends - counts)[far], counts[far])] = more
        return out, counts
