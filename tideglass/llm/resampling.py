"""Importance resampling of documents towards a target: hashed n-grams of words, log ratios of their buckets, noise.

The texts of a batch stand in one byte string, apart from each other by a sentinel that no UTF-8 text has. One pass of a
regular expression finds the words of all of them and the sentinels, which are the documents' offsets among the words;
searchsorted over these says whose a word is, and runs of words that cross two documents are masked out before buckets
are counted. Counts of buckets, bounded by their number, are all that the driver sees.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tideglass.llm.common import fresh, in_order, small_batches, written

#: What [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ matches, seen as UTF-8 bytes of lower-cased texts, and the sentinel.
_WORD = re.compile(rb"[0-9a-z\x80-\xf7]+|\xff")
_APART = b"\xff"
#: Bytes of texts that are joined at once, and distinct words whose buckets a worker remembers.
_JOINED, _KNOWN = 1 << 21, 1 << 19


class _Hashes(dict):
    """crc32 of each word; -1 for the sentinel."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN:
            self.clear()
        self[word] = found = -1 if word == _APART else zlib.crc32(word)
        return found


def _joined(texts):
    """Groups of texts of bounded size; a longer text is a group by itself."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= _JOINED:
            yield group
            group, size = [], 0
    if group:
        yield group


def _runs(texts: list[bytes], most: int, hashes: _Hashes):
    """(number of words of each text, [(hash, text it belongs to) of the runs of 1 .. most words])."""
    found = _WORD.findall(_APART.join(texts).lower())  # bytes: A-Z only
    crc = np.fromiter(map(hashes.__getitem__, found), np.int64, len(found))
    is_word = crc >= 0
    offsets = np.flatnonzero(~is_word)
    owner = np.searchsorted(offsets, np.arange(len(found)), "right")
    made = [(crc[is_word], owner[is_word])]
    chained = crc.tolist() if most > 1 else []
    for k in range(1, most):
        chained = [zlib.crc32(b" " + w, c) if c >= 0 else c for c, w in zip(chained, found[k:], strict=False)]
        inside = (owner[: len(chained)] == owner[k:]) & is_word[: len(chained)]
        made.append((np.array(chained, np.int64)[inside], owner[: len(chained)][inside]))
    return np.bincount(made[0][1], minlength=len(texts)), made


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def bucket_counts(docs: DataFrame, text_col: str = "text", most: int = 1, buckets: int = 10_000) -> np.ndarray:
    """How many runs of 1 .. most words of all texts fall into each bucket; nulls, empty texts and empty tables add none."""

    def run(batches):
        hashes, total = _Hashes(), np.zeros(buckets, np.int64)
        for b in batches:
            for group in _joined(_texts(b.column(0))):
                for crc, _ in _runs(group, most, hashes)[1]:
                    total += np.bincount(crc % buckets, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    rows = small_batches(docs).select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket int, n long")
    counts = np.zeros(buckets, np.int64)
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n")).collect():  # a row a bucket
        counts[bucket] = n
    return counts


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of each bucket's smoothed share in the target over that in the raw texts."""
    m = len(raw)
    all_raw, all_target = float(int(raw.sum()) + m), float(int(target.sum()) + m)
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_raw / ((s + 1.0) * all_target))) for s, t in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def weighted(docs: DataFrame, gains: np.ndarray, names: tuple[str, str, str] = ("n_words", "n_features", "weight"), text_col: str = "text", most: int = 1) -> DataFrame:
    """docs with three longs under the given names: words, runs of 1 .. most words, and the sum of the runs' gains.

    A null or empty text has none of them and weight 0. Every row is kept, repeated ones too, with all its columns.
    """
    at = docs.columns.index(text_col)
    schema = StructType([*docs.schema.fields, *(StructField(n, LongType()) for n in names)])

    def run(batches):
        hashes = _Hashes()
        for b in batches:
            columns = ([], [], [])
            for group in _joined(_texts(b.column(at))):
                n_words, runs = _runs(group, most, hashes)
                features, weight = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
                for crc, owner in runs:
                    ends = np.searchsorted(owner, np.arange(len(group)), "right")
                    sums = np.concatenate([[0], np.cumsum(gains[crc % len(gains)])])[ends]
                    weight += np.diff(sums, prepend=0)
                    features += np.diff(ends, prepend=0)
                for c, x in zip(columns, (n_words, features, weight), strict=True):
                    c.append(x)
            made = [pa.array(np.concatenate(c) if c else np.zeros(0), pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays([*b.columns, *made], names=[*b.schema.names, *names])

    return small_batches(docs).mapInArrow(run, schema)


def _noise(seed: str, id_col: str):
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, most: int = 1, buckets: int = 10_000, seed: str = "2024", id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """Per row of docs: doc_id, n_features, weight, score and, for the drawn ones, rank.

    Of the rows with at least least_words words, the floor(percent * N / 100) of the highest scores are drawn, ties to
    the smaller id. A null id draws noise like an empty one and comes last among ties; rows that agree in id and text
    are ranked one after another. Null and empty texts have no words, an empty target only smoothed counts, an empty
    table no rows. Other columns play no part.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    gains = bucket_gains(bucket_counts(narrow, "text", most, buckets), bucket_counts(target, target_col, most, buckets))
    scored = weighted(narrow, gains, most=most).drop("text").withColumn("score", F.col("weight") + _noise(seed, "doc_id"))
    kept = written(scored, "scores")
    enough = kept.filter(F.col("n_words") >= least_words)
    drawn = percent * enough.count() // 100
    ranked = in_order(enough, [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "rank")
    rest = kept.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    rows = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(rest)
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


def draw_documents(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, most: int = 1, buckets: int = 10_000, seed: str = "2024", id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """The drawn rows of docs with all their columns, by the rule of resample(), without shuffling a text.

    The last drawn (score, id) is the threshold; rows that agree with it in both stay together. Nothing drawn gives no rows.
    """
    ranks = resample(docs, target, percent, least_words, most, buckets, seed, id_col, text_col, target_col)
    last = ranks.filter("rank IS NOT NULL").orderBy(F.col("rank").desc()).select("score", "doc_id").first()
    if last is None:
        return docs.limit(0)
    gains = bucket_gains(bucket_counts(docs, text_col, most, buckets), bucket_counts(target, target_col, most, buckets))
    names = fresh(docs, 4)
    scored = weighted(docs, gains, tuple(names[:3]), text_col, most).withColumn(names[3], F.col(names[2]) + _noise(seed, id_col))
    score, own = F.col(names[3]), F.col(id_col)
    before = own.isNotNull() | F.lit(last["doc_id"] is None) if last["doc_id"] is None else own <= F.lit(last["doc_id"])
    taken = (score > last["score"]) | ((score == last["score"]) & F.coalesce(before, F.lit(False)))
    return scored.filter((F.col(names[0]) >= least_words) & taken).select(*docs.columns)


def resample_sql(percent: int = 10, least_words: int = 20, buckets: int = 10_000, seed: str = "2024") -> str:
    """The same in SQL for single words; crc32 is worked out from its polynomial, once for each distinct word."""
    words = lambda t, key: f"SELECT {key} AS k, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM {t}"
    step = "list_reduce([x] || range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    return f"""
        WITH d AS MATERIALIZED ({words('documents', 'doc_id')}), b AS MATERIALIZED ({words('benchmark', 'item_id')}),
        tab AS (SELECT list({step} ORDER BY x) AS t FROM range(256) r(x)),
        v AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM d UNION SELECT w FROM b)),
        c AS MATERIALIZED (SELECT w, xor(list_reduce([4294967295::BIGINT] || [('0x' || substr(h, 2 * i + 1, 2))::BIGINT FOR i IN range(strlen(w))], lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1])), 4294967295) % {buckets} AS g FROM v, tab),
        s AS (SELECT g, count(*) AS n FROM d JOIN c USING (w) GROUP BY g), t AS (SELECT g, count(*) AS n FROM b JOIN c USING (w) GROUP BY g),
        z AS (SELECT (SELECT count(*) FROM d) + {buckets} AS s_all, (SELECT count(*) FROM b) + {buckets} AS t_all),
        gains AS (SELECT g, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * s_all::DOUBLE / ((s.n + 1)::DOUBLE * t_all::DOUBLE))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (g), z),
        f AS (SELECT k, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight FROM d JOIN c USING (w) JOIN gains USING (g) GROUP BY k),
        e AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, ('0x' || substr(sha256('{seed}:' || CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT AS h FROM documents LEFT JOIN f ON k = doc_id),
        o AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM e),
        r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS many FROM o WHERE n_features >= {least_words})
        SELECT o.doc_id, n_features, weight, score, CASE WHEN rank <= {percent} * many // 100 THEN rank END AS rank FROM o LEFT JOIN r ON r.doc_id = o.doc_id
    """
