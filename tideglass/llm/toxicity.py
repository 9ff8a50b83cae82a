"""Toxicity by weak supervision.

A bounded sample of labelled rows tells which words and word beginnings mark toxic texts. These and a fixed list of
insults, dealt to many voters, vote on every document, besides patterns (insults spoken to somebody, dense hits,
shouting). The distinct patterns of votes, counted over all documents, fit a generative model of the voters' accuracies and correlations,
in which given labels only anchor the voters' rates. Its posteriors of the votes, not the given labels, choose the marks
of a linear classifier and train it. It is trained on the labelled sample and on a sample of other rows, as many of those
with votes and of those without as of each label. It scores all texts in one pass.

Labels are read from training rows only: those whose crc32 of the id as text, modulo FOLDS, isn't 0.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideglass.llm.bpe_codec import in_batches
from tideglass.llm.common import release_memory, released, small_batches, written
from tideglass.llm.label_model import LabelModel, Logistic
from tideglass.llm.words import WordTable

FOLDS = 5
#: Labelled rows of each label, at most, from which marks are learned; as many other rows with and without votes join them for the classifier.
SAMPLE = 10_000
#: Marks that the classifier weighs, at most.
MARKS = 2048
_BITS = 20  # of a mark's hash
_GROUPS = 8  # voters among which learned marks are dealt
_UNITS = 1024  # of a posterior, so that sums of them don't depend on order
_BEGINNINGS = range(3, 8)
_WORD = re.compile(r"[^\W\d_]+")
# fixed values: common English insults
_INSULTS = frozenset("idiot moron stupid dumb loser scum trash garbage worthless pathetic disgusting clown fool jerk creep coward liar vermin filth pig".split())
_AT_SOMEBODY = re.compile(r"\b(?:you|your|youre|u)\b(?:\W+\w+){0,3}?\W+(?:" + "|".join(sorted(_INSULTS)) + r")\b")
_SHOUT = re.compile(r"\b[A-Z]{4,}\b")
_WORD_CACHE = 1 << 17
_AT_ONCE = 1 << 19  # characters of texts that are looked at together
_NAMES = [f"marks_{k}" for k in range(_GROUPS)] + ["insults", "many_insults", "at_somebody", "dense_marks", "shouting"]


def marks_of(word: str) -> list[int]:
    """Hashes of a word and of its beginnings."""
    raw = word.encode("utf-8", "surrogatepass")
    found = [zlib.crc32(raw, 1)]
    found += [zlib.crc32(word[:k].encode("utf-8", "surrogatepass"), 2) for k in _BEGINNINGS if len(word) >= k]
    return [x & ((1 << _BITS) - 1) for x in found]


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def _letters() -> np.ndarray:
    """Which characters words consist of."""
    return np.array([bool(_WORD.match(chr(c))) for c in range(0x110000)])


_tables: list[np.ndarray] = []


class Cut:
    """The lower-cased words of a batch of texts: where they stand in its bytes, and the text of each."""

    def __init__(self, texts: list[str]):
        if not _tables:
            _tables.append(_letters())
        low = [t.lower() for t in texts]
        joined = "\0".join(low) + "\0"
        self.data = joined.encode("utf-8", "surrogatepass") + bytes(16)
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        inside = np.zeros(len(chars) + 1, np.int8)
        inside[:-1] = _tables[0][chars]
        turn = np.diff(inside, prepend=np.int8(0))
        begin, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        edges = np.cumsum(np.fromiter(map(len, low), np.int64, len(low)) + 1) - 1
        self.of_word = np.searchsorted(edges, begin)
        if len(self.data) != len(joined) + 16:
            place = np.zeros(len(chars) + 1, np.int64)
            np.cumsum(1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000), out=place[1:])
            begin, end = place[begin], place[end]
        self.at, self.sizes = begin, end - begin

    def lists(self, known: WordTable, of_one) -> tuple[np.ndarray, np.ndarray]:
        """(numbers that of_one gives for each word, in a row, the text of each); known remembers them."""

        def learn(at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            made = [of_one(self.data[a : a + n].decode("utf-8", "surrogatepass")) for a, n in zip(at.tolist(), sizes.tolist(), strict=True)]
            return np.array([k for m in made for k in m], np.int32), np.array([len(m) for m in made], np.int64)

        room = known.room
        parts = [known.lists(self.data, self.at[k : k + room], self.sizes[k : k + room], learn) for k in range(0, len(self.at), room)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([p[0] for p in parts]).astype(np.int64), np.repeat(self.of_word, np.concatenate([p[1] for p in parts]))


class Found:
    """What a batch of texts holds: the number of words of each text, and the marks in a row with the text of each."""

    def __init__(self, words: np.ndarray, of: np.ndarray, marks: np.ndarray):
        self.words, self.of, self.marks = words, of, marks

    def counts(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, mark, how often), ascending."""
        both, n = np.unique(self.of * width + self.marks, return_counts=True)
        return both // width, both % width, n


class Marker:
    """Counts the chosen marks of texts, a batch at once; remembers the marks of distinct words.

    A group of marks votes for a text in which they are more than its cut of the words.
    """

    def __init__(self, chosen: np.ndarray, cuts: np.ndarray | None = None):
        self.cuts = np.zeros(_GROUPS) if cuts is None else cuts
        self.index = {int(c): k for k, c in enumerate(chosen)}
        self.group = np.array([(int(c) * 2654435761 >> 7) % _GROUPS for c in chosen], np.int64)
        self.known = WordTable(_WORD_CACHE)

    def _of(self, word: str) -> list[int]:
        """The numbers of a word's marks; an insult has the number behind the last besides."""
        found = [k for x in marks_of(word) if (k := self.index.get(x)) is not None]
        return found + [len(self.index)] * (word in _INSULTS)

    def find(self, texts: list[str]) -> tuple[Found, np.ndarray]:
        """What texts hold of marks, and each text's number of insults."""
        cut = Cut(texts)
        hits, of = cut.lists(self.known, self._of)
        rude = hits == len(self.index)
        return Found(np.bincount(cut.of_word, minlength=len(texts)), of[~rude], hits[~rude]), np.bincount(of[rude], minlength=len(texts))

    def density(self, found: Found) -> np.ndarray:
        """Each group's marks as a share of the words, for each text."""
        n = len(found.words)
        return np.bincount(found.of * _GROUPS + self.group[found.marks], minlength=n * _GROUPS).reshape(n, _GROUPS) / np.maximum(found.words, 1)[:, None]

    def votes(self, texts: list[str]) -> np.ndarray:
        """The votes on each text as bits."""
        found, rude = self.find(texts)
        hits = np.bincount(found.of, minlength=len(texts))
        at_somebody, shouting = np.zeros(len(texts), bool), np.zeros(len(texts), bool)
        for k in np.flatnonzero(rude).tolist():
            at_somebody[k] = bool(_AT_SOMEBODY.search(texts[k].lower()))
        for k, text in enumerate(texts):
            upper = len(_SHOUT.findall(text))
            shouting[k] = upper > 5 and upper > 0.2 * found.words[k]
        dense = (hits >= 3) & (hits > 0.01 * found.words)
        votes = np.column_stack([self.density(found) > self.cuts, rude > 0, rude > 2, at_somebody, dense, shouting])
        return votes @ (np.int64(1) << np.arange(votes.shape[1]))

    def scores(self, texts: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
        """Each text's chance to be toxic, by a linear classifier of its counts of marks."""
        found, _ = self.find(texts)
        text, mark, n = found.counts(max(1, len(self.index)))
        z = np.bincount(text, weights[mark] * _values(n), len(texts)) + bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _values(counts: np.ndarray) -> np.ndarray:
    """What the classifier weighs, of counts of marks."""
    return np.log1p(counts) / np.log1p(8)


def _texts(batches, columns: int):
    for b in batches:
        yield from zip(*(b.column(k).to_pylist() for k in range(columns)), (t.as_py() or "" for t in b.column(columns)), strict=True)


def _groups(batches, columns: int):
    """(one list a column, texts) of bounded size; a text by itself may be longer."""
    rows, size = [], 0
    for row in _texts(batches, columns):
        rows.append(row)
        size += len(row[-1])
        if size >= _AT_ONCE:
            yield [*map(list, zip(*rows, strict=True))]
            rows, size = [], 0
    if rows:
        yield [*map(list, zip(*rows, strict=True))]
    release_memory()


def choose_marks(sample: DataFrame, marks: int = MARKS, judge=None) -> np.ndarray:
    """The marks whose share of toxic texts lies surest above that of clean ones, by documents of the sample (toxic, text).

    judge() makes a function that gives the chances of texts to be toxic, in _UNITS; without it the sample's labels hold.
    """

    def count(batches):
        n, sizes, chance, known = np.zeros((2, 1 << _BITS), np.int64), np.zeros(2, np.int64), judge and judge(), WordTable(_WORD_CACHE)
        for labels, texts in _groups(batches, 1):
            toxic = chance(texts) if chance else np.array(labels, np.int64) * _UNITS
            sizes += (_UNITS * len(texts) - toxic.sum(), toxic.sum())
            hits, of = Cut(texts).lists(known, marks_of)
            both = np.unique(of << _BITS | hits)  # a mark counts once a text
            mark, place = np.unique(both & ((1 << _BITS) - 1), return_inverse=True)
            own = toxic[both >> _BITS]
            n[0, mark] += np.bincount(place, _UNITS - own, len(mark)).astype(np.int64)
            n[1, mark] += np.bincount(place, own, len(mark)).astype(np.int64)
        used = np.flatnonzero(n.any(axis=0))
        # mark -1 counts the documents
        yield pa.RecordBatch.from_arrays([pa.array([-1, *used], pa.int64()), *(pa.array([size, *own], pa.int64()) for size, own in zip(sizes, n[:, used], strict=True))], ["mark", "clean", "toxic"])

    counted = sample.select("toxic", "text").mapInArrow(count, "mark long, clean long, toxic long")
    # at most 2**_BITS rows, those seen in few toxic texts stay behind
    t = counted.groupBy("mark").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter((F.col("toxic") >= 3 * _UNITS) | (F.col("mark") < 0)).toPandas()
    sizes, t = t[t["mark"] < 0], t[t["mark"] >= 0]
    a, b = t["toxic"].to_numpy(float) / _UNITS + 0.5, t["clean"].to_numpy(float) / _UNITS + 0.5
    n1, n0 = sizes["toxic"].sum() / _UNITS + 1, sizes["clean"].sum() / _UNITS + 1
    lead = np.log(a / (n1 - a + 0.5)) - np.log(b / (n0 - b + 0.5))
    sure = lead / np.sqrt(1 / a + 1 / b)
    good = np.flatnonzero((sure > 3) & (lead > 1))
    best = good[np.lexsort((t["mark"].to_numpy()[good], -sure[good]))][:marks]
    return t["mark"].to_numpy(np.int64)[best]


def choose_cuts(sample: DataFrame, chosen: np.ndarray) -> np.ndarray:
    """For each group of marks, the density that tells most of the labels of the sample (toxic, text)."""

    def dense(batches):
        marker = Marker(chosen)

        def made():
            for labels, texts in _groups(batches, 1):
                for toxic, own in zip(labels, marker.density(marker.find(texts)[0]).astype("<f8"), strict=True):
                    yield 8 * _GROUPS, (toxic, own.tobytes())

        yield from in_batches(made(), {"toxic": pa.int64(), "density": pa.binary()})

    # a row for each row of the sample
    t = sample.select(F.col("toxic").cast("long"), "text").mapInArrow(dense, "toxic long, density binary").toPandas()
    y, cuts = t["toxic"].to_numpy(float), np.zeros(_GROUPS)
    if not 0 < y.sum() < len(y):
        return cuts
    entropy = lambda n, k: sum(-x * np.log(np.maximum(x, 1e-12) / np.maximum(n, 1e-12)) for x in (k, n - k))
    d = np.frombuffer(b"".join(map(bytes, t["density"])), "<f8").reshape(-1, _GROUPS)
    for j in range(_GROUPS):
        at, where = np.unique(d[:, j], return_inverse=True)
        n, k = np.bincount(where).cumsum(), np.bincount(where, y).cumsum()
        # voting for toxic only: where the share of toxic texts is greater above the cut
        left = np.where((y.sum() - k) * n >= k * (len(y) - n), entropy(n, k) + entropy(len(y) - n, y.sum() - k), np.inf)
        cuts[j] = at[np.argmin(left)]
    return cuts


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, marks: int = MARKS, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, np.ndarray, float, LabelModel]:
    """(chosen marks, their weights, bias, label model)."""
    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).filter("toxic in (0, 1)").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # the rows of lowest hash: 2 * sample rows at most, so they may be broadcast
    one = lambda y: known.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    picked = written(one(0).unionByName(one(1)), "picked")
    # samples are dealt anew: of a large table each task gives few rows of them, of a small one a single task may give all
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    taken = written(rows.join(F.broadcast(picked), "doc_id").repartition(tasks), "sample")
    voting = choose_marks(taken, marks)
    cuts = choose_cuts(taken, voting)

    def vote(batches):
        marker = Marker(voting, cuts)
        for ids, texts in _groups(batches, 1):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(marker.votes(texts), pa.int64())], ["doc_id", "votes"])

    votes = written(rows.mapInArrow(vote, "doc_id long, votes long"), "votes")
    # one row for each pattern of votes and label: 3 * 2**13 at most
    table = votes.join(known, "doc_id", "left").groupBy("votes", F.coalesce("toxic", F.lit(-1)).alias("given")).count().toPandas()
    # in order, so that sums of floats don't depend on the order of tasks
    table = table.sort_values(["votes", "given"], kind="stable")
    bits = np.arange(len(_NAMES))
    spread = lambda v: (v[:, None] >> bits & 1).astype(np.int8)
    patterns = table["votes"].to_numpy(np.int64)
    model = LabelModel().fit(spread(patterns), table["given"].to_numpy(np.int64), table["count"].to_numpy(np.int64))
    if not len(table):
        return np.zeros(0, np.int64), np.zeros(0), float(np.log(0.1 / 0.9)), model

    # other training rows, with and without votes, those of lowest hash: 2 * sample rows at most
    others = votes.filter(~held_out(F.col("doc_id"))).join(F.broadcast(picked.select("doc_id")), "doc_id", "left_anti").groupBy("doc_id").agg(F.max("votes").alias("votes"))
    more = lambda some: others.filter((F.col("votes") > 0) == some).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id")
    used = written(picked.select("doc_id").unionByName(more(True)).unionByName(more(False)), "used")
    chance = {int(v): int(round(_UNITS * p)) for v, p in zip(patterns, model.posterior(spread(patterns)), strict=True)}

    def judge():
        marker = Marker(voting, cuts)
        return lambda texts: np.array([chance[v] for v in marker.votes(texts).tolist()], np.int64)

    judged = written(rows.join(F.broadcast(used), "doc_id").select(F.lit(0).alias("toxic"), "doc_id", "text").repartition(tasks), "judged")
    chosen = choose_marks(judged, marks, judge)

    def sparse(batches):
        marker, likely = Marker(chosen), judge()

        def made():
            for ids, texts in _groups(batches, 1):
                of, mark, n = marker.find(texts)[0].counts(max(1, len(chosen)))
                ends = np.searchsorted(of, np.arange(len(texts) + 1)).tolist()
                for doc, p, a, z in zip(ids, likely(texts).tolist(), ends, ends[1:], strict=False):
                    yield 8 * (z - a) + 16, (doc, p, mark[a:z].astype("<i4").tobytes(), n[a:z].astype("<i4").tobytes())

        yield from in_batches(made(), {"doc_id": pa.int64(), "toxic": pa.int64(), "at": pa.binary(), "count": pa.binary()})

    # a row for each row of the samples
    t = judged.select("doc_id", "text").mapInArrow(sparse, "doc_id long, toxic long, at binary, count binary").toPandas()
    t = t.sort_values(["doc_id", "toxic", "at", "count"], kind="stable")
    flat = lambda c: np.frombuffer(b"".join(map(bytes, t[c])), "<i4")
    row = np.repeat(np.arange(len(t)), [len(x) // 4 for x in t["at"]]).astype(np.int64)
    line = Logistic(len(chosen)).fit(row, flat("at").astype(np.int64), _values(flat("count")), t["toxic"].to_numpy(float) / _UNITS)
    if not len(chosen):
        line.bias = float(np.log(model.prior / (1 - model.prior)))
    return chosen, line.weights, line.bias, model


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, marks: int = MARKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of docs: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.5).

    Scores come from the text alone; a null text counts as empty and gets the score of no marks. Labels other than 0 and
    1 are no labels; of several for one id the greatest holds. Without labels only the fixed voters tell what to learn, and
    without their votes all scores are low. Rows without id are scored but not learned from.
    Repeated rows get equal scores; a null id isn't held out. Other columns are not read. An empty table gives an empty result.
    """
    chosen, weights, bias, _ = fit(docs, labels, sample, marks, id_col, text_col)

    def score(batches):
        marker = Marker(chosen)
        for ids, texts in _groups(batches, 1):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(marker.scores(texts, weights, bias))], ["doc_id", "score"])

    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, marks: int = MARKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without those that score 0.5 or more, all columns as they are.

    Null and empty texts have the score of no marks; rows of null or repeated ids are judged by their texts, so equal ones
    stay or go together. An empty table gives an empty result.
    """
    chosen, weights, bias, _ = fit(docs, labels, sample, marks, id_col, text_col)
    at_col = docs.columns.index(text_col)

    def keep(batches):
        marker = Marker(chosen)
        for whole in batches:
            for k in range(0, whole.num_rows, 100):
                b = whole.slice(k, 100)
                yield b.filter(pa.array(marker.scores([t.as_py() or "" for t in b.column(at_col)], weights, bias) < 0.5, pa.bool_()))

    return docs.mapInArrow(lambda batches: released(keep(batches)), docs.schema)
