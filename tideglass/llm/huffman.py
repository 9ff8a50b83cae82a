"""Canonical length-limited Huffman codes over token ids, and their vectorised coding in numpy."""

from __future__ import annotations

import numpy as np

#: Longest code word in bits; decoding looks up so many bits at once, so its table has 2**LIMIT entries.
LIMIT = 20
_AT_ONCE = 1 << 14


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most `limit` bits (package-merge); 0 for symbols that do not occur.

    One symbol alone gets one bit.
    """
    used = np.flatnonzero(counts > 0)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols have no code of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaf = counts[order].astype(np.float64)
    # which entries of each level's merged list are leaves; packages pair the entries of the level below
    levels, weights = [], leaf
    levels.append(np.ones(len(leaf), bool))
    for _ in range(limit - 1):
        half = len(weights) // 2
        packed = weights[: 2 * half].reshape(half, 2).sum(axis=1)
        both = np.concatenate([leaf, packed])
        by = np.argsort(both, kind="stable")
        weights = both[by]
        levels.append(by < len(leaf))
    # from the top: of the first n entries, the leaves count for their symbols, the packages take two each from below
    n, own = 2 * len(leaf) - 2, np.zeros(len(leaf), np.int64)
    for is_leaf in reversed(levels):
        leaves = int(is_leaf[:n].sum())
        own[:leaves] += 1
        n = 2 * (n - leaves)
    lengths[order] = own
    return lengths


class Codec:
    """The canonical code of given lengths: words ascend by (length, symbol)."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        used = np.flatnonzero(self.lengths)
        order = used[np.lexsort((used, self.lengths[used]))]
        size = self.lengths[order]
        self.limit = int(size.max()) if len(size) else 1
        # the value of each word on `limit` bits is the sum of the spans of those before it
        spans = np.int64(1) << (self.limit - size)
        first = np.cumsum(spans) - spans
        self.words = np.zeros(len(lengths), np.uint64)
        self.words[order] = (first >> (self.limit - size)).astype(np.uint64)
        self._short = self.lengths.astype(np.int8)
        self.symbol = np.repeat(order, spans).astype(np.int32)
        self.symbol = np.concatenate([self.symbol, np.zeros((1 << self.limit) - len(self.symbol), np.int32)])
        self.size = self.lengths[self.symbol]
        self.both = self.symbol.astype(np.int64) << 8 | self.size

    def pack(self, ids: np.ndarray, every: int) -> tuple[bytes, np.ndarray]:
        """(bits of ids, the bit offset of each `every`-th id): the first bit is the highest of the first byte."""
        size = self._short[ids]
        ends = np.cumsum(size, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        starts = ends - size
        # each word touches at most two 32-bit cells, as words are shorter than 32 bits
        cells = np.zeros(total // 32 + 2, np.uint64)
        for k in range(0, len(ids), _AT_ONCE):  # so many words' arrays stay near the processor
            own = slice(k, k + _AT_ONCE)
            cell = starts[own] >> 5
            wide = self.words[ids[own]] << (64 - (starts[own] & 31) - size[own]).astype(np.uint64)
            # words of one cell stand side by side and share no bit, so a sum joins them
            first = np.flatnonzero(np.diff(cell, prepend=-1))
            cells[cell[first]] |= np.add.reduceat(wide >> np.uint64(32), first)
            cells[cell[first] + 1] |= np.add.reduceat(wide & np.uint64(0xFFFFFFFF), first)
        raw = cells.astype(">u4").tobytes()
        return raw[: (total + 7) // 8], starts[::every].copy()

    def unpack(self, raw: bytes, n: int, offsets: np.ndarray, every: int) -> np.ndarray:
        """The n ids of a block: all stretches between checkpoints are decoded side by side, one id a step each."""
        data = np.frombuffer(raw + bytes(8), np.uint8)
        # four bytes from each position on hold 25 usable bits; words have LIMIT at most
        at, out = offsets.astype(np.int64).copy(), np.empty((min(every, n), len(offsets)), np.int32)
        mask, limit = (1 << self.limit) - 1, self.limit
        # 32 bits from each byte on: every stretch reads its own
        wide = data.astype(np.uint32)
        window = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]
        top = len(window) - 1
        for k in range(len(out)):
            word = (window[np.minimum(at >> 3, top)] >> (32 - limit - (at & 7)).astype(np.uint32)) & np.uint32(mask)
            both = self.both[word]
            out[k] = both >> 8
            at += both & 255
        full = np.zeros((len(offsets), every), np.int32)
        full[:, : len(out)] = out.T
        return full.ravel()[:n]
