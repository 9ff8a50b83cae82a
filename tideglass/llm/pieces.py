"""Sentence pieces by a prefix table: the last piece of every prefix, found by an automaton and tests of pairs.

Merging takes the best-scored pair of neighbours first, of equal ones the leftmost. A sequence of pieces is what it gives
exactly when each two neighbours are what it gives for their own text: before a first merge across a border nothing
outside could have changed what happens beside it. So each prefix has one last piece, the one that ends there and fits
the last piece of what stands before it. The table is filled from left to right, ids are read off from the right.
"""

from __future__ import annotations

import codecs
from itertools import chain

import numpy as np

from tideglass.llm.words import WordTable

_SPACE = "▁"  # fixed: how pieces show a blank
#: Distinct words that a worker remembers, and pairs of pieces.
CACHE, _PAIRS = 1 << 19, 1 << 21
#: Longer words, up to so many bytes, that a worker remembers.
_FAR, _FAR_SIZE = 1 << 17, 64
_PLAIN, _BLANK, _LONE, _EDGE = range(4)
_loaded: dict[str, PieceEncoder] = {}


def _each_byte(fault: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (fault.end - fault.start), fault.end


codecs.register_error("tideglass_each_byte", _each_byte)


class Pieces:
    """The pieces of a model file with their ranks, and which of them may stand side by side."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        self.lib = lib = SentencePieceProcessor(model_file=path)
        many = range(lib.vocab_size())
        self.text = [lib.id_to_piece(k).replace(_SPACE, " ") for k in many]
        normal = [k for k in many if not (lib.is_control(k) or lib.is_unknown(k) or lib.is_byte(k))]
        self.bos, self.eos = lib.bos_id(), lib.eos_id()
        self.id_of = {self.text[k]: k for k in normal}
        by_score = {s: r for r, s in enumerate(sorted({lib.get_score(k) for k in normal}, reverse=True))}
        self.rank = {self.text[k]: by_score[lib.get_score(k)] for k in normal if not lib.is_unused(k)}
        self.byte = {int(self.text[k][3:5], 16): k for k in many if lib.is_byte(k)}
        self.control = {k for k in many if lib.is_control(k)}
        self.unknown = lib.unk_id()
        #: Pieces whose blank goes when they come first.
        self.leads = {k for k in normal if self.text[k].startswith(" ")}
        # how each piece is made: (left, right, rank, whether parts come before the whole throughout); None: by no merge
        self._made: dict[str, tuple[str, str, int, bool] | None] = {}
        self._fits: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for w, k in self.id_of.items():
            if len(w) == 1 or w in self.rank and self.merge([*w]) == [w]:
                self.automaton.add_word(w, (len(w), k))
        self.automaton.make_automaton()
        joined = {c for w in self.rank if len(w) > 1 for c in w}
        if lone := sorted(joined - self.id_of.keys()):
            raise ValueError(f"pieces hold characters that are none themselves, such as {lone[:3]}")
        #: Characters of longer pieces; all others stand alone.
        self.joining = joined
        #: Whether a text can be cut before each blank behind something else.
        self.cuts = not any(" " in w.lstrip(" ") for w in self.rank)
        self.raw = [b"" if k in self.control else bytes([int(w[3:5], 16)]) if lib.is_byte(k) else w.encode() for k, w in enumerate(self.text)]
        self.raw[self.unknown] = lib.decode([self.unknown]).encode()

    def merge(self, symbols: list[str]) -> list[str]:
        """What merging makes of a few symbols, step by step."""
        rank = self.rank
        while len(symbols) > 1:
            found = [(r, k) for k in range(len(symbols) - 1) if (r := rank.get(symbols[k] + symbols[k + 1])) is not None]
            if not found:
                break
            _, k = min(found)
            if len(symbols) == 2:
                self._made[symbols[0] + symbols[1]] = (*symbols, found[0][0], all(self._early(s, found[0][0]) for s in symbols))
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
        return symbols

    def _early(self, part: str, before: int) -> bool:
        """Whether a part's merges are all made before one of the given rank."""
        how = self.made(part)
        return how is None or how[2] < before and how[3]

    def made(self, piece: str) -> tuple[str, str, int, bool] | None:
        if len(piece) == 1:
            return None
        if piece not in self._made:
            self.merge([*piece])
        return self._made[piece]

    def _fit(self, a: str, b: str) -> bool:
        """Whether merging leaves the texts of two pieces as these two.

        Where parts always come before the whole, merges happen in order of rank. Seen backwards, the later of the two
        latest merges is undone; while edges stood side by side, a merge of the two of lower rank would have come first.
        """
        rank, left, right = self.rank, self.made(a), self.made(b)
        if left and not left[3] or right and not right[3]:
            return self.merge([*a, *b]) == [a, b]
        if a + b in rank:
            return False
        while left or right:
            if left and (not right or left[2] > right[2]):
                limit, a = left[2], left[1]
                left = self.made(a)
            else:
                limit, b = right[2] + 1, right[0]
                right = self.made(b)
            if rank.get(a + b, limit) < limit:
                return False
        return True

    def last_pieces(self, word: str) -> list[int]:
        """The last piece of each prefix of a word whose characters are all pieces; -1 for the empty one."""
        last, fits, many = [-1] * (len(word) + 1), self._fits, len(self.text)
        for end, (size, k) in self.automaton.iter(word):
            end += 1
            if last[end] < 0:
                before = last[end - size]
                if before < 0:
                    last[end] = k
                    continue
                good = fits.get(before * many + k)
                if good is None:
                    if len(fits) >= _PAIRS:
                        fits.clear()
                    good = fits[before * many + k] = self._fit(self.text[before], self.text[k])
                if good:
                    last[end] = k
        return last

    def encode_word(self, word: str) -> list[int]:
        if len(word) == 1 and word not in self.id_of:
            return [self.byte[b] for b in word.encode("utf-8", "surrogatepass")] if self.byte else [self.unknown]
        last, ids, at = self.last_pieces(word), [], len(word)
        while at:
            ids.append(last[at])
            at -= len(self.text[last[at]])
        return ids[::-1]

    def decode(self, ids: bytes) -> str:
        """The text of ids: control pieces give none, the first blank goes, single bytes join to UTF-8 or are replaced."""
        own = np.frombuffer(ids, "<u4").tolist()
        text = b"".join(map(self.raw.__getitem__, own)).decode("utf-8", "tideglass_each_byte")
        first = next((k for k in own if k not in self.control), None)
        return text[1:] if first is not None and first in self.leads else text


class PieceEncoder:
    """Texts to ids for one model file; texts are cut into words where no piece can cross, and words looked up for a whole batch."""

    def __init__(self, path: str, room: int = CACHE):
        self.pieces = Pieces(path)
        every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
        normal = self.pieces.lib.normalize
        #: Whether normalising only sets a blank before the text.
        self.plain = normal(every + "  a  ") == _SPACE + (every + "  a  ").replace(" ", _SPACE) and not normal("")
        self.words = WordTable(room)
        self.far: dict[bytes, list[int]] = {}
        self._class = np.full(0x110000, _LONE, np.uint8)
        self._class[[ord(c) for c in self.pieces.joining]] = _PLAIN
        if self.pieces.cuts:
            self._class[32] = _BLANK

    @classmethod
    def of(cls, path: str) -> PieceEncoder:
        return _loaded.get(path) or _loaded.setdefault(path, cls(path))

    def _word(self, raw: bytes) -> list[int]:
        if (ids := self.far.get(raw)) is None:
            ids = self.pieces.encode_word(raw.decode("utf-8", "surrogatepass"))
            if WordTable.SIZE < len(raw) <= _FAR_SIZE:
                if len(self.far) >= _FAR:
                    self.far.clear()
                self.far[raw] = ids
        return ids

    def _learn(self, data: bytes):
        def learn(at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            made = [self._word(data[a : a + n]) for a, n in zip(at.tolist(), sizes.tolist(), strict=True)]
            return np.array([*chain.from_iterable(made)], np.int32), np.fromiter(map(len, made), np.int64, len(made))

        return learn

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text with begin and end, as little-endian unsigned 32-bit integers."""
        shown = [(" " + t if t else t) if self.plain else self.pieces.lib.normalize(t) for t in texts]
        joined = "\0".join(shown).replace(_SPACE, " ") + "\0"
        data = joined.encode("utf-8", "surrogatepass") + bytes(16)
        chars = np.frombuffer(data, np.uint8)[: len(joined)] if len(data) == len(joined) + 16 else np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        kind = self._class[chars]
        edges = np.cumsum(np.fromiter(map(len, shown), np.int64, len(shown)) + 1) - 1
        kind[edges] = _EDGE
        start = np.ones(len(chars), bool)
        start[1:] = (kind[1:] >= _LONE) | (kind[:-1] >= _LONE) | (kind[1:] == _BLANK) & (kind[:-1] != _BLANK)
        begin = np.flatnonzero(start)
        end = np.append(begin[1:], len(chars))
        real = kind[begin] != _EDGE
        begin, end = begin[real], end[real]
        upto = np.searchsorted(begin, edges)
        if chars.itemsize > 1:
            place = np.zeros(len(chars) + 1, np.int64)
            np.cumsum(1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000), out=place[1:])
            begin, end = place[begin], place[end]
        learn, room, made = self._learn(data), self.words.room, []
        for k in range(0, max(1, len(begin)), room):
            made.append(self.words.lists(data, begin[k : k + room], end[k : k + room] - begin[k : k + room], learn))
        ids = np.concatenate([x for x, _ in made]).astype("<u4", copy=False).tobytes()
        ends = (np.concatenate([[0], np.cumsum(np.concatenate([n for _, n in made]))])[upto] * 4).tolist()
        first, last = (np.array([k], "<u4").tobytes() for k in (self.pieces.bos, self.pieces.eos))
        return [first + ids[a:b] + last for a, b in zip([0, *ends], ends, strict=False)]

    def encode_each(self, texts, most: int = 1 << 19):
        """encode_batch over groups of so many characters, one result for each text."""
        group, size = [], 0
        for t in texts:
            group.append(t)
            size += len(t)
            if size >= most:
                yield from self.encode_batch(group)
                group, size = [], 0
        if group:
            yield from self.encode_batch(group)
