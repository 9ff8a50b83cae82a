"""Byte-pair encoding by speculation: greedy proposals, vectorised checks of adjacent pairs, exact merging of the rest.

A sequence of tokens is what merging in rank order gives exactly when each token is what merging gives for its own bytes
and no merge ever crosses a boundary between neighbours. Greedy longest match proposes a sequence for each new word; all
pairs of neighbours of a batch are checked together; words with a pair that fails are merged exactly, many at once.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
import regex

from tideglass.llm.words import WordTable, ranges

_END = b"\xff"  # stands for the end-of-word mark: no UTF-8 text holds this byte
_NONE = np.int32(np.iinfo(np.int32).max)
#: Words up to so many symbols are merged together as rows of a matrix; longer ones one by one.
_WIDE = 64
#: Distinct words that a worker remembers.
CACHE = 1 << 19


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class _Table:
    """Exact lookup of many non-negative long keys at once, by open addressing; missing keys give `none`."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, none: int):
        bits = max(10, int(np.ceil(np.log2(len(keys) + 1))) + 2)
        self._shift, self._mask, self._none = np.uint64(64 - bits), (1 << bits) - 1, none
        self._keys, self._values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, none, np.int32)
        slots, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            at = slots[todo]
            free = self._keys[at] == -1
            self._keys[at[free]] = keys[todo[free]]  # of several for one slot the last stays
            won = free & (self._keys[at] == keys[todo])
            self._values[at[won]] = values[todo[won]]
            todo = todo[~won]
            slots[todo] = (slots[todo] + 1) & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self._shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slot(keys)
        there = self._keys[slots]
        out = np.where(there == keys, self._values[slots], np.int32(self._none))
        todo = np.flatnonzero((there != keys) & (there != -1))
        while len(todo):
            slots[todo] = (slots[todo] + 1) & self._mask
            there = self._keys[slots[todo]]
            hit = there == keys[todo]
            out[todo[hit]] = self._values[slots[todo[hit]]]
            todo = todo[~hit & (there != -1)]
        return out


class Merges:
    """A vocabulary with its ranked merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        chars, vocab = _byte_alphabet(), model["vocab"]

        def raw(token: str) -> bytes | None:
            body, mark = (token[: -len(self.suffix)], _END) if self.suffix and token.endswith(self.suffix) else (token, b"")
            return bytes(map(chars.__getitem__, body)) + mark if all(c in chars for c in body) else None

        self.size = max(vocab.values()) + 1
        self.token_bytes: list[bytes] = [b""] * self.size
        for token, k in vocab.items():
            self.token_bytes[k] = raw(token) or b""
        by_char = {b: c for c, b in chars.items()}
        self.start = np.array([vocab[by_char[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[by_char[b] + self.suffix] for b in range(256)], np.int32) if self.suffix else self.start
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left, right = (np.array([vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self._pairs = _Table(left << 20 | right, np.arange(len(pairs), dtype=np.int32), int(_NONE))
        # how each token is made: the merge of lowest rank; -1 where none makes it
        self.rank = np.full(self.size, -1, np.int32)
        self.left, self.right = np.full(self.size, -1, np.int32), np.full(self.size, -1, np.int32)
        for k in range(len(pairs) - 1, -1, -1):
            t = self.merged[k]
            self.rank[t], self.left[t], self.right[t] = k, left[k], right[k]
        # the check of pairs needs parts that are made before the whole
        made = self.rank >= 0
        self.ordered = bool((self.rank[self.left[made]] < self.rank[made]).all() and (self.rank[self.right[made]] < self.rank[made]).all())
        own = [(w, k) for k, w in enumerate(self.token_bytes) if w.removesuffix(_END)]
        ids, sizes = self._merge(*self._symbols(np.frombuffer(b"".join(w for w, _ in own), np.uint8), np.array([len(w) for w, _ in own], np.int64)))
        first = np.cumsum(sizes) - sizes
        #: What greedy matching may propose: tokens that merging gives for their own bytes.
        self.proposals = {w: k for (w, k), n, at in zip(own, sizes.tolist(), first.tolist(), strict=True) if n == 1 and ids[at] == k}
        self._grow_trie()

    def _grow_trie(self) -> None:
        step: dict[tuple[int, int], int] = {}
        token = [-1]
        for w, k in self.proposals.items():
            at = 0
            for b in w:
                if (following := step.get((at, b))) is None:
                    following = step[at, b] = len(token)
                    token.append(-1)
                at = following
            token[at] = k
        keys = np.array([n << 8 | b for n, b in step], np.int64)
        self._step, self._token = _Table(keys, np.fromiter(step.values(), np.int32, len(step)), -1), np.array(token, np.int32)

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; _NONE where there is none. Negative symbols have none."""
        keys = a.astype(np.int64) << 20 | b.astype(np.int64)
        keys[(a < 0) | (b < 0)] = (1 << 40) - 1
        return self._pairs.get(keys)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge crosses the boundary between token a and token b.

        Seen backwards from the whole tokens, the later of the two merges is undone at each step. While a pair of edge
        tokens stood side by side, a merge of the two came first if its rank is below that of the merge which ended
        their being neighbours; at equal ranks merges go from left to right.
        """
        good = self.pair_ranks(a, b) == _NONE
        todo, a, b = np.flatnonzero(good), a[good], b[good]
        while len(todo):
            ra, rb = self.rank[a], self.rank[b]
            live = (ra >= 0) | (rb >= 0)
            todo, a, b, ra, rb = todo[live], a[live], b[live], ra[live], rb[live]
            back = ra > rb
            limit = np.where(back, ra, rb + 1)
            a, b = np.where(back, self.right[a], a), np.where(back, b, self.left[b])
            bad = self.pair_ranks(a, b) < limit
            good[todo[bad]] = False
            todo, a, b = todo[~bad], a[~bad], b[~bad]
        return good

    def _symbols(self, body: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The single-byte ids of words in a row, and how many each has."""
        ids = self.start[body]
        if self.suffix:
            sizes = sizes.copy()
            ends = np.cumsum(sizes) - 1
            marked = ends[body[ends] == _END[0]]
            ids[marked - 1] = self.last[body[marked - 1]]
            ids = np.delete(ids, marked)
            sizes -= body[ends] == _END[0]
        return ids, sizes

    def _merge(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The exact encoding of words given as symbols in a row: ids in a row, and how many each word has."""
        starts, made = np.cumsum(sizes) - sizes, sizes.copy()
        slots = flat.copy()  # results stand where their word's symbols stood
        order = np.argsort(sizes, kind="stable")
        short = order[sizes[order] <= _WIDE]
        for k in range(0, len(short), 8192):
            self._merge_rows(short[k : k + 8192], starts, sizes, slots, made)
        for k in np.flatnonzero(sizes > _WIDE):
            ids = self._merge_one(flat[starts[k] : starts[k] + sizes[k]])
            slots[starts[k] : starts[k] + len(ids)], made[k] = ids, len(ids)
        return slots[ranges(starts, made)], made

    def _merge_rows(self, of: np.ndarray, starts: np.ndarray, sizes: np.ndarray, slots: np.ndarray, made: np.ndarray) -> None:
        width = int(sizes[of[-1]])
        if not width:
            return
        s = np.full((len(of), width + 1), -1, np.int32)
        inside = np.arange(width + 1) < sizes[of][:, None]
        s[inside] = slots[ranges(starts[of], sizes[of])]
        r = self.pair_ranks(s[:, :-1].ravel(), s[:, 1:].ravel()).reshape(len(of), width)
        cols = np.arange(width + 1)
        while len(s):
            p = r.argmin(axis=1)
            best = r[np.arange(len(s)), p]
            done = best == _NONE
            if done.any():
                own, rows = of[done], s[done]
                filled = rows >= 0
                made[own] = filled.sum(axis=1)
                slots[ranges(starts[own], made[own])] = rows[filled]
                keep = ~done
                s, r, p, best, of = s[keep], r[keep], p[keep], best[keep], of[keep]
                if not len(s):
                    break
            rows = np.arange(len(s))
            s[rows, p] = self.merged[best]
            s = np.take_along_axis(s, np.minimum(cols + (cols > p[:, None]), width), 1)
            r = np.take_along_axis(r, np.minimum(cols[:-1] + (cols[:-1] > p[:, None]), width - 1), 1)
            s[:, -1], r[:, -1] = -1, _NONE
            r[rows, p] = self.pair_ranks(s[rows, p], s[rows, np.minimum(p + 1, width)])
            before = np.maximum(p - 1, 0)
            r[rows, before] = np.where(p > 0, self.pair_ranks(s[rows, before], s[rows, p]), r[rows, before])

    def _merge_one(self, word: np.ndarray) -> np.ndarray:
        """One long word, by a heap of candidate merges over a linked list."""
        ids, n = word.tolist(), len(word)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        ranks = self.pair_ranks(word[:-1], word[1:])
        heap = [(int(ranks[k]), int(k), ids[k], ids[k + 1]) for k in np.flatnonzero(ranks != _NONE)]
        heapq.heapify(heap)
        known: dict[tuple[int, int], int] = {}
        while heap:
            rank, k, a, b = heapq.heappop(heap)
            m = after[k]
            if ids[k] != a or m < 0 or ids[m] != b:
                continue
            ids[k], ids[m] = int(self.merged[rank]), -1
            after[k] = after[m]
            if after[m] >= 0:
                before[after[m]] = k
            for x, y in ((before[k], k), (k, after[k])):
                if x >= 0 and y >= 0:
                    pair = ids[x], ids[y]
                    if (rank := known.get(pair)) is None:
                        rank = known[pair] = int(self.pair_ranks(np.array(pair[:1]), np.array(pair[1:]))[0])
                    if rank != _NONE:
                        heapq.heappush(heap, (rank, x, *pair))
        return np.array([x for x in ids if x >= 0], np.int32)

    def _longest(self, body: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, size) of the longest token that starts at each place and ends before `end`; size 0 where there is none."""
        best, size = np.full(len(at), -1, np.int32), np.zeros(len(at), np.int64)
        who, node, depth = np.arange(len(at)), np.zeros(len(at), np.int64), 0
        while len(who):
            node = self._step.get(node << 8 | body[at[who] + depth])
            there = node >= 0
            who, node, depth = who[there], node[there].astype(np.int64), depth + 1
            token = self._token[node]
            ends_here = token >= 0
            best[who[ends_here]], size[who[ends_here]] = token[ends_here], depth
            inside = at[who] + depth < end[who]
            who, node = who[inside], node[inside]
        return best, size

    def propose(self, body: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Greedy longest match: (ids in a row, how many each word has, which words it could not finish).

        All words take a step at once. Words of more than _WIDE bytes match at every place first, so that the number of
        steps doesn't follow the longest word's tokens.
        """
        ends = np.cumsum(sizes)
        best, size = np.full(len(body), -1, np.int32), np.zeros(len(body), np.int64)
        wide = np.flatnonzero(sizes > _WIDE)
        if len(wide):
            own = ranges(ends[wide] - sizes[wide], sizes[wide])
            best[own], size[own] = self._longest(body, own, np.repeat(ends[wide], sizes[wide]))
        taken, stuck = np.zeros(len(body), bool), np.zeros(len(sizes), bool)
        who = np.flatnonzero((sizes > 0) & (sizes <= _WIDE))
        at = ends[who] - sizes[who]
        while len(who):
            best[at], size[at] = self._longest(body, at, ends[who])
            none = size[at] == 0
            stuck[who[none]] = True
            who, at = who[~none], at[~none]
            taken[at] = True
            at = at + size[at]
            more = at < ends[who]
            who, at = who[more], at[more]
        for k in wide.tolist():
            at, end = int(ends[k] - sizes[k]), int(ends[k])
            steps, own = size[at:end].tolist(), []
            p = 0
            while p < len(steps) and steps[p]:
                own.append(p)
                p += steps[p]
            stuck[k] = p < len(steps)
            taken[at + np.array(own, np.int64)] = True
        at = np.flatnonzero(taken)
        cum = np.concatenate([[0], np.cumsum(taken)])
        return best[at], cum[ends] - cum[ends - sizes], stuck

    def encode(self, body: np.ndarray, given: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that stand in a row in body, with so many bytes each (the end mark included where the
        vocabulary has one): ids in a row, and how many each word has."""
        if not len(given):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        if not self.ordered:
            return self._merge(*self._symbols(body, given))
        ids, sizes, failed = self.propose(body, given)
        owner = np.repeat(np.arange(len(given)), sizes)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        fine = self.compatible(ids[inner], ids[inner + 1])
        failed[owner[inner[~fine]]] = True
        again = np.flatnonzero(failed)
        starts = np.cumsum(given) - given
        exact, counts = self._merge(*self._symbols(body[ranges(starts[again], given[again])], given[again])) if len(again) else (ids[:0], sizes[:0])
        total = sizes.copy()
        total[again] = counts
        starts, out = np.cumsum(total) - total, np.empty(int(total.sum()), np.int32)
        out[ranges(starts[~failed], total[~failed])] = ids[~failed[owner]]
        out[ranges(starts[again], counts)] = exact
        return out, total


_WS = "\t-\r \x85\xa0  -     　"  # fixed: what \s matches in the vocabularies' patterns
_WS_CHARS = [" ", *(chr(c) for c in range(0x3001) if chr(c) != " " and re.match(f"[{_WS}]", chr(c)))]
_BLOCK = 1 << 19  # characters of a text that are cut into words at once
_CUT = re.compile(f"(?<=[^{_WS}])[ \n](?=[^{_WS}])")
_LATIN = 0x250  # characters below are classed here, those from here on by the library's own tables
_BLANK, _LETTER, _NUMBER, _OTHER, _EDGE, _UNKNOWN = range(6)
_loaded: dict[str, TextEncoder] = {}


class TextEncoder:
    """Texts to ids for one vocabulary file; remembers distinct words between the batches of a worker.

    Characters are classed, and texts cut into words where classes change, for a whole batch at once.
    """

    def __init__(self, path: str, room: int = CACHE):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.merges = Merges(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in spec["added_tokens"]}
        self._split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.spaces = not self.merges.suffix  # whether white space makes ids
        self.words = WordTable(room)
        self._class = np.full(0x110000, _UNKNOWN, np.uint8)
        for c in map(chr, range(_LATIN)):
            self._class[ord(c)] = _BLANK if c in _WS_CHARS else _LETTER if regex.match(r"\p{L}", c) else _NUMBER if regex.match(r"\p{N}", c) else _OTHER

    @classmethod
    def of(cls, path: str) -> TextEncoder:
        return _loaded.get(path) or _loaded.setdefault(path, cls(path))

    def _ask(self, c: str) -> int:
        """The class of a character, as the library's cutting shows it."""
        cuts = lambda lead: [span for _, span in self.lib.pre_tokenizer.pre_tokenize_str(lead + c)]
        for lead, kind in (("a", _LETTER), ("!", _OTHER)):
            if (0, 2) in cuts(lead):
                return kind
        return _NUMBER if (0, 2) in cuts("1") or not self.spaces and (1, 2) in cuts("a") else _BLANK

    def _classes(self, chars: np.ndarray) -> np.ndarray:
        found = self._class[chars]
        unknown = np.unique(chars[found == _UNKNOWN])
        if len(unknown):
            self._class[unknown] = [self._ask(chr(c)) for c in unknown.tolist()]
            found = self._class[chars]
        return found

    def _starts(self, chars: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Where words start; an edge is a word, and so is white space."""
        start = np.ones(len(chars), bool)
        np.not_equal(kind[1:], kind[:-1], out=start[1:])
        if self.spaces:
            # the last of several blanks is by itself, unless it ends the text; a space there belongs to what follows
            last = np.flatnonzero((kind[:-1] == _BLANK) & start[1:])
            last = last[kind[last + 1] != _EDGE]
            start[last] = True
            start[last[chars[last] == 32] + 1] = False
        else:
            start |= kind == _NUMBER
        # a word that starts with an apostrophe and one of these ends with them: s t m d re ve ll
        at = np.flatnonzero(chars == 39)
        at = at[start[at]]
        at = at[kind[at + 1] == _LETTER]
        if len(at):
            one, two = chars[at + 1], chars[np.minimum(at + 2, len(chars) - 1)]
            size = np.where(np.isin(one, [*map(ord, "stmd")]), 2, 0)
            for a, b in ("re", "ve", "ll"):
                size[(one == ord(a)) & (two == ord(b))] = 3
            at, size = at[size > 0], size[size > 0]
            start[at + 1] = False
            start[at + size] = True
        return start

    def _cut(self, blocks: list[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        """(UTF-8 bytes of all blocks, where their words begin, their sizes, the number of words up to each block's end)."""
        if not self.spaces:
            latin = all(map(str.isascii, blocks)) or int(np.frombuffer("".join(blocks).encode("utf-32-le", "surrogatepass"), "<u4").max()) < _LATIN
            blocks = [b.lower() if latin or b.isascii() or ord(max(b)) < _LATIN else self.lib.normalizer.normalize_str(b) for b in blocks]
        joined = "\0".join(blocks) + "\0"
        data = joined.encode("utf-8", "surrogatepass") + bytes(16)
        ascii_ = len(data) == len(joined) + 16
        chars = np.frombuffer(data, np.uint8)[: len(joined)] if ascii_ else np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        kind = self._classes(chars)
        edges = np.cumsum(np.fromiter(map(len, blocks), np.int64, len(blocks)) + 1) - 1
        kind[edges] = _EDGE
        begin = np.flatnonzero(self._starts(chars, kind))
        end = np.append(begin[1:], len(chars))
        real = kind[begin] != _EDGE
        if not self.spaces:
            real &= kind[begin] != _BLANK
        begin, end = begin[real], end[real]
        upto = np.searchsorted(begin, edges)
        if not ascii_:
            place = np.zeros(len(chars) + 1, np.int64)
            np.cumsum(1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000), out=place[1:])
            begin, end = place[begin], place[end]
        return data, begin, end - begin, upto

    def _encode_words(self, data: bytes, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(data, np.uint8)
        if not self.spaces:
            # an end mark behind each word
            body = np.full(int(sizes.sum()) + len(sizes), _END[0], np.uint8)
            body[ranges(np.cumsum(sizes + 1) - sizes - 1, sizes)] = raw[ranges(at, sizes)]
            return self.merges.encode(body, sizes + 1)
        return self.merges.encode(raw[ranges(at, sizes)], sizes)

    def _ids(self, data: bytes, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and where each word's end."""
        room = self.words.room
        learn = lambda at, sizes: self._encode_words(data, at, sizes)
        made = [self.words.lists(data, at[k : k + room], sizes[k : k + room], learn) for k in range(0, max(1, len(at)), room)]
        if len(made) == 1:
            return made[0][0], np.cumsum(made[0][1])
        return np.concatenate([ids for ids, _ in made]), np.cumsum(np.concatenate([n for _, n in made]))

    def _blocks(self, text: str):
        at, n = 0, len(text)
        while n - at > _BLOCK and (m := _CUT.search(text, at + _BLOCK)):
            yield text[at : m.start()]
            at = m.start()
        yield text[at:]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        blocks, parts = [], []  # parts: a block's number, or the id of a special token
        for text in texts:
            own: list[int | bytes] = []
            for part in self._split.split(text) if any(s in text for s in self.special) else (text,):
                if part in self.special:
                    own.append(self.special[part])
                    continue
                for block in self._blocks(part):
                    own.append(len(blocks))
                    blocks.append(block)
            parts.append(own)
        if not blocks:
            return [b"".join(own) for own in parts]
        data, at, sizes, upto = self._cut(blocks)
        ids, ends = self._ids(data, at, sizes)
        raw = memoryview(ids.astype("<u4", copy=False).tobytes())
        ends = (np.concatenate([[0], ends])[upto] * 4).tolist()
        made = [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        return [bytes(made[own[0]]) if len(own) == 1 and type(own[0]) is int else b"".join(x if type(x) is bytes else made[x] for x in own) for own in parts]

    def encode_each(self, texts, most: int = 1 << 19):
        """encode_batch over groups of so many characters, one result for each text."""
        group, size = [], 0
        for t in texts:
            group.append(t)
            size += len(t)
            if size >= most:
                yield from self.encode_batch(group)
                group, size = [], 0
        yield from self.encode_batch(group)


class Vocabulary:
    """The bytes of each id, for decoding."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars, suffix = _byte_alphabet(), spec["model"].get("end_of_word_suffix") or ""
        vocab = spec["model"]["vocab"]
        self.of_id = [b""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for token, k in vocab.items():
            ends = suffix and token.endswith(suffix)
            body = token.removesuffix(suffix) if ends else token
            self.of_id[k] = (bytes(map(chars.__getitem__, body)) if all(c in chars for c in body) else body.encode()) + b" " * bool(ends)
        for t in spec["added_tokens"]:
            self.of_id[t["id"]] = t["content"].encode()

    def decode(self, ids: bytes) -> str:
        """The text of ids; words of a vocabulary with word ends are set apart by blanks."""
        return b"".join(map(self.of_id.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")
