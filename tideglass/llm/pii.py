"""Personal data: generators propose spans, boosted trees score them, calibrated thresholds select.

Base spans follow fixed rules and are always kept. Looser generators propose more: telephone numbers without a country
code, cards with other separators, mail addresses written out, addresses of IPv6, identity numbers, keys and passwords.
Proposals may overlap each other. Trees are grown on a bounded sample of examples of all six kinds, by features of format
and context. Examples are the corpus's own proposals where a check decides them (check digits, number ranges, mixed
characters) with their look-alikes, and made ones: the corpus's mail addresses, numbers and cards rewritten into the looser
forms, and noise of the same shapes, set into stretches of its texts. Per kind, a threshold between the scores of the part
of the sample that was kept back selects proposals; of overlapping ones a checked one stays before others, then the longer,
then the better scored, and none that overlaps a base span.
"""

from __future__ import annotations

import bisect
import heapq
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideglass.llm.boosting import Boosted
from tideglass.llm.bpe_codec import in_batches
from tideglass.llm.common import drop_written, released, small_batches, written

KINDS = ("email", "ip", "card", "phone", "id", "secret")
BASE = KINDS[:4]
#: Examples, at most, on which trees are grown and thresholds set.
SAMPLE = 20_000
#: Share of selected examples that must be positive on the part kept back.
PRECISION = 0.95
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_AT, _DOT = ("[at]", "(at)", " at "), ("[dot]", "(dot)", " dot ")
_KEYS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "xox")
_NAMES = ("password", "passwd", "pwd", "token", "secret", "api")
# looser forms: kind, what a text that holds one has to hold, and the pattern, which starts with few characters of one
# class, so that most of a text is passed over; each quantifier is bounded or runs over one class, so that time is linear
_LOOSE = (
    ("email", lambda t: any(x in t for x in _AT) and any(x in t for x in _DOT), re.compile(r"\b[A-Za-z0-9._%+-]{1,64} ?(?:\[at\]|\(at\)| at ) ?[A-Za-z0-9-]{1,63} ?(?:\[dot\]|\(dot\)| dot ) ?[A-Za-z]{2,12}\b")),
    ("ip", lambda t: t.count(":") >= 7, re.compile(r"[0-9A-Fa-f](?<![0-9A-Fa-f:].)[0-9A-Fa-f]{0,3}:(?:[0-9A-Fa-f]{1,4}:){6}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])", re.S)),
    ("card", _DIGIT.search, re.compile(r"[0-9](?<![0-9.].)[0-9]{3}[./][0-9]{4}[./][0-9]{4}[./][0-9]{4}(?![0-9.])", re.S)),
    ("card", _DIGIT.search, re.compile(r"3(?<![0-9].)[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}(?![0-9])", re.S)),
    ("phone", _DIGIT.search, re.compile(r"[0-9](?<![0-9A-Za-z+(].)(?<![0-9][ ./:-].)[0-9]{1,3}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![ ./:-]?[0-9])", re.S)),
    ("phone", _DIGIT.search, re.compile(r"\((?<![0-9+].)[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])", re.S)),
    ("id", _DIGIT.search, re.compile(r"[0-9](?<![0-9-].)[0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9-])", re.S)),
    ("id", _DIGIT.search, re.compile(r"[A-Z](?<!\w.)[A-Z][0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b", re.S)),
    ("secret", lambda t: "AKIA" in t or "ASIA" in t, re.compile(r"A(?<!\w.)(?:KIA|SIA)[A-Z0-9]{16}\b", re.S)),
    ("secret", lambda t: any(x in t for x in _KEYS), re.compile(r"\b(?:gh[pousr]_|sk-|xox[abprs]-)[A-Za-z0-9_-]{16,}")),
    ("secret", lambda t: any(map(t.lower().__contains__, _NAMES)), re.compile(r"\b(?:password|passwd|pwd|token|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?[^\s\"']{6,}", re.I | re.A)),
)
# fixed values: words that announce personal data, words that announce other numbers, common ends of domains
_CUES = ("mail", "contact", "write", "call", "tel", "phone", "fax", "mobile", "card", "visa", "account", "pay", "ip", "host", "server", "address", "ssn", "iban", "key", "pass", "token")
_OTHERS = ("order", "invoice", "number", "no", "nr", "ref", "case", "version", "isbn", "page", "room", "part", "item", "year", "since", "until", "ratio", "time")
_ENDS = ("com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "io", "co", "us", "uk", "de", "fr", "es", "it", "nl", "ch", "at", "be", "se", "no", "dk", "fi", "pl", "cz", "ru", "jp", "cn", "in", "br", "ca", "au", "nz", "eu")
_WORDS = re.compile(r"[a-z]+")
_SHAPE = (
    "length", "digits", "letters", "upper", "groups", "longest", "shortest", "dots", "dashes", "blanks", "brackets", "first_digit", "distinct", "before_letter", "before_digit", "after_letter", "after_digit", "after_dot", "line_start", "cue", "other", "near_digits",
    "checked", "known_end", "year_first", "classes", "mixed", "hex_letters", "long_groups",
)
_FEATURES = len(_SHAPE) + len(KINDS)


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_candidates(text: str):
    """(kind, start, end, passes) of all matches of the fixed rules, whether or not they pass their checks.

    Matches are leftmost and don't overlap within a kind, as of a search that goes on behind each match. An address is
    found from its @ sign: a match starts at the run of name characters before it, cut at the last match's end.
    """
    last = floor = 0
    at = text.find("@")
    while at >= 0:
        seg = text[max(last, floor) : at]
        start = at - (len(seg) - len(seg.rstrip(_LOCAL)))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield "email", start, m.end(), True
            last = m.end()
        floor = at + 1
        at = text.find("@", max(floor, last))
    if not _DIGIT.search(text):
        return
    for m in _CHAIN.finditer(text):
        parts = m.group().split(".")
        at = m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            size = sum(map(len, four)) + 3
            yield "ip", at, at + size, all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four)
            at += size + 1
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        yield "card", *m.span(), 16 <= len(digits) <= 19 and _luhn(digits)
    for m in _PHONE.finditer(text):
        yield "phone", *m.span(), 8 <= sum(c.isdigit() for c in m.group()) <= 15


def loose_candidates(text: str):
    """(kind, start, end) of the looser forms; they may overlap."""
    for kind, may, pattern in _LOOSE:
        if may(text):
            for m in pattern.finditer(text):
                yield kind, *m.span()


def _id_check(body: str) -> bool:
    """Number ranges of nine-digit identity numbers, check digits of account numbers."""
    if body[0].isdigit():
        parts = body.split("-")
        return [*map(len, parts)] == [3, 2, 4] and parts[0] not in ("000", "666") and parts[0] < "900" and parts[1] != "00" and parts[2] != "0000"
    code = body.replace(" ", "")
    return code.isalnum() and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _value(body: str) -> str:
    """What a password's or key's name is set to, without closing signs."""
    return re.split(r"[=:]\s*[\"']?", body, maxsplit=1)[-1].rstrip(".,;:)]}")


def _classes(value: str) -> int:
    """How many of capitals, small letters, digits and signs a value has."""
    return sum(any(map(k, value)) for k in (str.isupper, str.islower, str.isdigit, lambda c: not c.isalnum()))


def _secret_check(body: str) -> bool:
    """Whether a key or a password mixes at least two of capitals, small letters, digits and signs, and many characters."""
    value = _value(body)
    return _classes(value) >= 2 and len(set(value)) >= 5


def _card_check(body: str) -> bool:
    digits = re.sub("[^0-9]", "", body)
    return 13 <= len(digits) <= 19 and _luhn(digits)


_CHECKS = {"id": _id_check, "secret": _secret_check, "card": _card_check}
#: What stands in the places of identity numbers and secrets without being any: groups of digits, identifiers, plain values.
_ALIKE = (
    ("id", re.compile(r"[0-9](?<![0-9-].)[0-9]{1,3}-[0-9]{2,4}-[0-9]{2,4}(?![0-9-])", re.S), None),
    ("secret", re.compile(r"[_-][A-Za-z0-9_-]{12,}"), re.compile(r"[A-Za-z0-9]+\Z")),
    ("secret", re.compile(r"=\s{0,3}[\"']?[^\s\"']{6,}"), re.compile(r"[A-Za-z]+\s{0,3}\Z")),
)


def candidates(text: str):
    """(kind, start, end, passes) of what a check decides: proposals of some kinds, and look-alikes that are none."""
    seen = set()
    for kind, a, e in loose_candidates(text):
        if kind in _CHECKS:
            seen.add(a)
            yield kind, a, e, _CHECKS[kind](text[a:e])
    for kind, pattern, lead in _ALIKE:
        for m in pattern.finditer(text):
            # what stands before a rare sign is looked for from there
            near = max(0, m.start() - 24)
            before = lead.search(text[near : m.start()]) if lead else None
            start = near + before.start() if before else m.start()
            if (before or not lead) and start not in seen:
                yield kind, start, m.end(), False


def _luhn_number(rng: random.Random, lead: str, size: int) -> str:
    body = lead + "".join(rng.choice("0123456789") for _ in range(size - len(lead) - 1))
    return next(body + c for c in "0123456789" if _luhn(body + c))


def _groups(rng: random.Random, *sizes: int) -> list[str]:
    return ["".join(rng.choice("0123456789") for _ in range(n)) for n in sizes]


def _account(rng: random.Random) -> str:
    """An account number with right check digits, in groups of four."""
    country, body = rng.choice(("DE", "FR", "ES", "NL", "AT", "IT")), "".join(rng.choice("0123456789") for _ in range(rng.choice((14, 16, 18, 20))))
    check = 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
    code = f"{country}{check:02}{body}"
    return code if rng.random() < 0.3 else " ".join(code[k : k + 4] for k in range(0, len(code), 4))


def _token(rng: random.Random, size: int, chars: str) -> str:
    return "".join(rng.choice(chars) for _ in range(size))


_SMALL, _CAPITAL, _ALL = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def made_example(kind: str, good: bool, words: list[str], own: dict[str, str], rng: random.Random) -> tuple[str, str]:
    """(cue, body): an example of a looser form, or noise of its shape; own: base spans of the text by kind, words: some of its words."""
    pick, word = rng.choice, lambda: rng.choice(words)
    cue = lambda *names: pick([f"{n}{c}" for n in names for c in (" ", ": ")]) if rng.random() < 0.5 else ""
    if kind == "email":
        local, _, domain = own.get("email", "").partition("@")
        local, host = (local, domain.split(".")[0]) if domain and rng.random() < 0.5 else (word() + pick(("", f".{word()}", str(rng.randrange(100)))), word())
        end = pick(_ENDS) if good else next((w for w in (word() for _ in range(9)) if w not in _ENDS and 2 <= len(w) <= 12), "there")
        (a, d), gap = pick([*zip(_AT, _DOT, strict=True)]), pick(("", " "))
        joined = f"{local}{a}{host}{d}{end}" if a == " at " else f"{local}{gap}{a}{gap}{host}{gap}{d}{gap}{end}"
        return cue("mail", "contact", "write") if good else "", joined
    if kind == "ip":
        if good:
            return cue("ip", "host", "server", "address"), ":".join(f"{rng.randrange(1 << pick((8, 16, 16, 16))):x}" for _ in range(8))
        return cue("time", "ratio"), ":".join(pick((_groups(rng, *[2] * 8), [_token(rng, 2, "0123456789abcdef") for _ in range(8)], _groups(rng, *[1] * 8))))
    if kind == "card":
        number = own.get("card", "").replace(" ", "").replace("-", "")
        number = number if len(number) == 16 and rng.random() < 0.5 else _luhn_number(rng, pick("3456") if rng.random() < 0.8 else pick("12789"), 16)
        if rng.random() < 0.3:
            number = _luhn_number(rng, pick(("34", "37")), 15)
        if not good:
            k = rng.randrange(len(number))
            number = number[:k] + str((int(number[k]) + rng.randrange(1, 10)) % 10) + number[k + 1 :] if len(number) == 16 else number[:14] + str((int(number[14]) + rng.randrange(1, 10)) % 10)
        cut = (4, 10, 15) if len(number) == 15 else (4, 8, 12, 16)
        return cue("card", "visa", "account") if good else "", pick((" ", "-", "") if len(number) == 15 else "./").join(number[x:y] for x, y in zip((0, *cut), cut, strict=False))
    if kind == "phone":
        a, b, c = _groups(rng, 3, pick((3, 4)), 4)
        if good:
            if rng.random() < 0.4:
                return cue("call", "tel", "phone", "fax", "mobile"), pick((f"({a}) {b}-{c}", f"({a}) {b} {c}", f"({a}) {b}.{c}"))
            if rng.random() < 0.5:
                return cue("call", "tel", "phone", "fax", "mobile"), pick(" .-").join(("0" + a[: pick((2, 3))], b, c))
            return pick(("call ", "tel ", "phone: ", "fax ", "mobile ")), pick(" .-").join((a, b, c))
        first = pick((f"{rng.randrange(1900, 2100)}", f"{rng.randrange(1, 10)}{a[1:]}"))
        return pick([f"{n} " for n in _OTHERS]) if rng.random() < 0.6 else "", pick((" ", " ", ".", "-")).join((first, b, c))
    if kind == "id":
        if rng.random() < 0.5:
            account = _account(rng)
            digit = rng.choice([k for k, c in enumerate(account) if k > 3 and c.isdigit()])
            return cue("iban", "account", "pay"), account if good else account[:digit] + str((int(account[digit]) + rng.randrange(1, 10)) % 10) + account[digit + 1 :]
        area, group, serial = f"{rng.randrange(1, 900):03}", f"{rng.randrange(1, 100):02}", f"{rng.randrange(1, 10_000):04}"
        if good:
            return cue("ssn"), "-".join(("667" if area == "666" else area, group, serial))
        return cue("part", "item", "order"), "-".join(pick((("000", group, serial), ("666", group, serial), (f"9{area[1:]}", group, serial), (area, "00", serial), (area, group, "0000"))))
    if good:
        value = pick((_token(rng, pick((7, 10, 16)), _ALL) + str(rng.randrange(10)) + pick(_SMALL), _token(rng, pick((32, 40)), "0123456789abcdef"), word() + str(rng.randrange(1000)) + pick("!?#$_"), word() + str(rng.randrange(10, 10_000))))
        value = value if _secret_check(value) and len(value) >= 6 else _token(rng, 12, _ALL) + "a1"
        return "", pick((f"{pick(_NAMES)}{pick(('=', ' = ', ': '))}{value}", f"{pick(('ghp_', 'gho_', 'sk-', 'xoxb-'))}{_token(rng, pick((20, 36)), _ALL)}a1", f"{pick(('AKIA', 'ASIA'))}{_token(rng, 15, _CAPITAL)}{rng.randrange(10)}"))
    plain = "".join((word(), word(), "something"))[: pick((6, 8, 14))]
    return "", pick((f"{pick(_NAMES)}{pick(('=', ' = ', ': '))}{pick((plain, plain.upper(), plain[0] * 8, str(rng.randrange(10**6, 10**7))))}{pick(('', ';', ',', ')'))}", f"{pick(('sk-', 'ghp_'))}{plain}{plain}{plain}"))


def _setting(text: str, rng: random.Random) -> tuple[str, str, list[str]]:
    """A stretch of a text before and behind a place of it, and some words around."""
    at = rng.randrange(len(text) + 1)
    at = at if at < 40 else (text.find(" ", at) + 1 or len(text))
    around = [w for w in _WORDS.findall(text[max(0, at - 200) : at + 200]) if 2 <= len(w) <= 12] or ["some", "words"]
    before = text[max(0, at - 40) : at]
    return before + (" " if before[-1:].isalnum() else ""), " " + text[at : at + 12].lstrip("0123456789"), around


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a span."""
    body, before, after = text[start:end], text[max(0, start - 40) : start], text[end : end + 12]
    groups = re.findall(r"[A-Za-z0-9]+", body) or [""]
    word = before.lower()
    # of two announcing words the nearer one counts
    place = lambda names: max((m.start() for n in names for m in re.finditer(rf"\b{n}", word)), default=-1)
    cue, other = place(_CUES), place(_OTHERS)
    first = re.match(r"\D*(\d+)", body)
    value = _value(body) if kind == "secret" else ""
    return [
        len(body), sum(c.isdigit() for c in body), sum(c.isalpha() for c in body), sum(c.isupper() for c in body), len(groups), max(map(len, groups)), min(map(len, groups)),
        body.count("."), body.count("-"), body.count(" "), body.count("(") + body.count(")"), int(body[0]) if body[0].isdigit() and body[0].isascii() else -1, len(set(body)),
        before[-1:].isalpha(), before[-1:].isdigit(), after[:1].isalpha(), after[:1].isdigit(), after[:1] == ".", not before or before[-1] == "\n", cue > other, other > cue, sum(c.isdigit() for c in before + after),
        kind in _CHECKS and _CHECKS[kind](body), kind == "email" and groups[-1].lower() in _ENDS, first is not None and len(first[1]) == 4 and first[1][:2] in ("19", "20"), _classes(value), len(set(value)),
        sum(c in "abcdefABCDEF" for c in body) if kind == "ip" else 0, sum(len(g) >= 3 for g in groups), *(k == kind for k in KINDS),
    ]


def _texts(batches):
    for b in batches:
        yield from zip(b.column(0).to_pylist(), (t.as_py() or "" for t in b.column(1)), strict=True)


def fit(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> tuple[Boosted, dict[str, float]]:
    """The trees and each kind's threshold."""

    each = sample // (4 * len(KINDS))

    def propose(batches):
        def rows():
            # of each kind, label and origin the lowest hashes of this task; only those need features
            lowest: dict[tuple[str, bool, bool], list] = defaultdict(list)

            def offer(doc, kind, good, made, at, example):
                held = lowest[kind, good, made]
                key = -zlib.crc32(f"{doc}:{kind}:{at}:{good}".encode()), -(doc or 0), -at
                if len(held) < each:
                    heapq.heappush(held, (key, example(-key[0])))
                elif key > held[0][0]:
                    heapq.heapreplace(held, (key, example(-key[0])))

            for doc, text in _texts(batches):
                for kind, a, e, good in candidates(text):
                    offer(doc, kind, good, False, a, lambda _, kind=kind, a=a, e=e: features(text, kind, a, e))  # noqa: B023
                own = {kind: text[a:e] for kind, a, e, good in base_candidates(text) if good} if text else {}

                def made(kind, good, seed):
                    rng = random.Random(seed)
                    before, after, words = _setting(text, rng)  # noqa: B023
                    cue, body = made_example(kind, good, words, own, rng)  # noqa: B023
                    return features(before + cue + body + after, kind, len(before + cue), len(before + cue + body))

                for kind in KINDS if text else ():
                    for good in (True, False):
                        offer(doc, kind, good, True, 0, lambda seed, kind=kind, good=good: made(kind, good, seed))  # noqa: B023
            for (kind, good, made_up), held in lowest.items():
                for (order, doc, at), x in held:
                    yield 300, (-order, -doc, KINDS.index(kind), -at, int(good), int(made_up), x)

        yield from in_batches(rows(), {"order": pa.int64(), "doc": pa.int64(), "kind": pa.int64(), "at": pa.int64(), "good": pa.int64(), "made": pa.int64(), "x": pa.list_(pa.float64())})

    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = written(rows.mapInArrow(propose, "order long, doc long, kind long, at long, good long, made long, x array<double>"), "candidates")
    # a bounded sample of each kind, label and origin: those of lowest hash
    keys = ["order", "doc", "kind", "at", "good", "made"]
    place = F.row_number().over(Window.partitionBy("kind", "good", "made").orderBy(*keys))
    t = found.withColumn("_place", place).filter(F.col("_place") <= each).drop("_place").toPandas().sort_values(keys, kind="stable")
    drop_written(found)
    x = np.array(t["x"].tolist(), float).reshape(-1, _FEATURES)
    y, kind = t["good"].to_numpy(float), t["kind"].to_numpy(int)
    back = np.arange(len(t)) % 4 == 0
    trees = Boosted().fit(x[~back], y[~back])
    p = trees.score(x[back])
    return trees, {name: threshold(p[kind[back] == k], y[back][kind[back] == k]) for k, name in enumerate(KINDS)}


def threshold(scores: np.ndarray, labels: np.ndarray, precision: float = PRECISION) -> float:
    """Halfway between the lowest score down to which selected examples are precise enough and the best one refused; 0.5 without examples of both labels."""
    if not 0 < labels.sum() < len(labels):
        return 0.5
    order = np.argsort(-scores, kind="stable")
    right = np.cumsum(labels[order]) / np.arange(1, len(order) + 1)
    whole = np.append(scores[order][1:] < scores[order][:-1], True)  # equal scores are selected together
    fine = np.flatnonzero((right >= precision) & whole)
    if not len(fine):
        return float(scores.max()) + 1e-9
    low = scores[order][fine[-1]]
    # the precise part ends with a positive; what is refused below it is the next score
    low = scores[(scores >= low) & (labels > 0)].min()
    below = scores[scores < low]
    return float((low + (below.max() if len(below) else 0)) / 2)


class Covered:
    """Stretches of a text, for tests of overlap; those given at the start ascend and may overlap each other."""

    def __init__(self, spans=()):
        self.starts, self.ends = [], []
        for a, e in spans:
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(a)
                self.ends.append(e)

    def meets(self, a: int, e: int) -> bool:
        k = bisect.bisect_left(self.starts, e) - 1
        return k >= 0 and self.ends[k] > a

    def add(self, a: int, e: int) -> None:
        """A stretch that meets none."""
        k = bisect.bisect_left(self.starts, a)
        self.starts.insert(k, a)
        self.ends.insert(k, e)


class Selector:
    """Chooses the spans of texts, given the trees and thresholds."""

    def __init__(self, trees: Boosted, limits: dict[str, float]):
        self.trees, self.limits = trees, limits

    def __call__(self, texts) -> list[list[tuple]]:
        """Per text, in order: (kind's number, kind, start, end, base, score)."""
        held, x = [], []
        for text in texts:
            base = [(k, a, e) for k, a, e, good in base_candidates(text) if good]
            fixed = Covered(sorted((a, e) for _, a, e in base))
            more = [c for c in loose_candidates(text) if not fixed.meets(c[1], c[2])]
            held.append((text, base, more))
            x += [features(text, *c) for c in more]
        scores, out = iter(self.trees.score(np.array(x, float).reshape(-1, _FEATURES)).tolist()), []
        for text, base, more in held:
            kept, taken = [], Covered()
            # a checked span before others, then the longer, then the better scored
            checked = lambda c: c[1] in _CHECKS and _CHECKS[c[1]](text[c[2] : c[3]])  # noqa: B023, E731
            for s, kind, a, e in sorted(((next(scores), *c) for c in more), key=lambda c: (not checked(c), c[2] - c[3], -c[0], c[2], c[1])):
                if s >= self.limits[kind] and not taken.meets(a, e):
                    taken.add(a, e)
                    kept.append((s, kind, a, e))
            out.append(sorted([(KINDS.index(k), k, a, e, True, 1.0) for k, a, e in base] + [(KINDS.index(k), k, a, e, False, s) for s, k, a, e in kept]))
        return out


def find_spans(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) for each row of docs: an array of (kind, start, end, base, score), ordered by kind, then start.

    start and end count code points, end exclusive. kind runs as in KINDS. Base spans have base = true and score 1. A
    null text counts as empty and has no spans; repeated rows give equal rows. Without look-alikes to learn from, trees
    are flat and thresholds 0.5. Other columns are not read. An empty table gives an empty result.
    """
    select = Selector(*fit(docs, sample, id_col, text_col))

    def run(batches):
        def rows():
            for b in batches:
                ids, texts = zip(*_texts([b]), strict=True) if b.num_rows else ((), ())
                for doc, spans in zip(ids, select(texts), strict=True):
                    yield 64 * len(spans) + 16, (doc, [dict(zip(("kind", "start", "end", "base", "score"), c[1:], strict=True)) for c in spans])

        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())])
        yield from in_batches(rows(), {"doc_id": pa.int64(), "spans": pa.list_(span)})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, spans array<struct<kind: string, start: long, end: long, base: boolean, score: double>>")


def redact(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with each span of its texts replaced by its kind in angle brackets; all columns stay as they are otherwise.

    Overlapping spans are replaced as one, under the first one's kind. A null text stays null, an empty one empty. Null and
    repeated ids, and further columns of any name, stay as they are; an empty table gives an empty result.
    """
    select = Selector(*fit(docs, sample, id_col, text_col))

    at_col = docs.columns.index(text_col)

    def hide(batches):
        for b in batches:
            texts = [t.as_py() for t in b.column(at_col)]
            out = []
            for text, spans in zip(texts, select([t or "" for t in texts]), strict=True):
                parts, at = [], 0
                for _, kind, a, e, _, _ in sorted(spans, key=lambda c: (c[2], c[3])):
                    if a >= at:
                        parts += [text[at:a], f"<{kind.upper()}>"]
                    at = max(at, e)
                out.append(text if not spans else "".join(parts) + text[at:])
            yield b.set_column(at_col, b.schema.field(at_col), pa.array(out, b.schema.field(at_col).type))

    return docs.mapInArrow(lambda batches: released(hide(batches)), docs.schema)


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_digests(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans.

    Null and empty texts have none, and the digest of nothing; null and repeated ids each keep their row; other columns
    are not read. An empty table gives an empty result.
    """
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return find_spans(docs).withColumn("base_spans", base).select("doc_id", *map(count, BASE), F.sha2(span_text(F.col("base_spans")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
