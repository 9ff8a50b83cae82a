"""Importance resampling against a plain version that counts word by word."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from tideglass.llm.resampling import draw_documents, resample

BUCKETS = 10_000


def features(text, most):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [" ".join(words[k : k + n]) for n in range(1, most + 1) for k in range(len(words) - n + 1)]


def plain(docs, target, percent=10, least=20, most=1):
    bucket = lambda f: zlib.crc32(f.encode()) % BUCKETS
    s, t = (Counter(bucket(f) for x in texts for f in features(x, most)[1]) for texts in ([x for _, x in docs], target))
    total = lambda c: float(sum(c.values()) + BUCKETS)
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * total(s) / ((s[b] + 1.0) * total(t))))
    rows = []
    for i, x in docs:
        n, own = features(x, most)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in own)
        rows.append((i, n, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    enough = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    place = {id(r): k for k, r in enumerate(enough[: percent * len(enough) // 100], 1)}
    return [(r[0], r[2], r[3], r[4], place.get(id(r))) for r in rows]


def sorted_rows(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x or 0) for x in r))


@pytest.mark.parametrize("most", [1, 3])
def test_equals_plain(spark, documents, sf_dir, most):
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = resample(documents, target, most=most).collect()
    wanted = plain([(r.doc_id, r.text) for r in documents.collect()], [r.text for r in target.collect()], most=most)
    assert sorted_rows(found) == sorted_rows(wanted)
    assert sum(r.rank is not None for r in found) > 5


def test_hard_tables(spark, hard, empty):
    found = resample(hard, hard.filter("doc_id > 5"), percent=50, least_words=1).collect()
    rows = [(r.doc_id, r.text) for r in hard.select("doc_id", "text").collect()]
    wanted = plain(rows, [x for i, x in rows if i is not None and i > 5], 50, 1)
    assert sorted_rows(r[:4] for r in found) == sorted_rows(r[:4] for r in wanted)  # of rows that tie either may be drawn
    assert sorted(r.rank for r in found if r.rank) == [*range(1, sum(r[4] is not None for r in wanted) + 1)]
    assert resample(empty, hard).count() == 0
    assert resample(hard, empty).count() == hard.count()


def test_ties_and_one_hot_text(spark):
    docs = spark.createDataFrame([(k, "the same words again") for k in range(300)] + [(7, "the same words again")] * 300 + [(None, "the same words again")] * 300, "doc_id long, text string")
    found = resample(docs, docs.limit(1), percent=40, least_words=1).collect()
    ranks = sorted((r.rank, -r.score, r.doc_id is None, r.doc_id or 0) for r in found if r.rank)
    assert [r[0] for r in ranks] == [*range(1, 361)]
    assert [r[1:] for r in ranks] == sorted(r[1:] for r in ranks)


def test_drawn_documents(spark, documents, sf_dir):
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    ids = {r.doc_id for r in resample(documents, target).collect() if r.rank}
    drawn = draw_documents(documents, target)
    assert drawn.columns == documents.columns and {r.doc_id for r in drawn.collect()} == ids
    assert draw_documents(documents, target, percent=0).count() == 0


def test_equals_sql(spark, sf_dir):
    """The registered queries of this round against their SQL."""
    duckdb = pytest.importorskip("duckdb")
    from tideglass.llm import queries

    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    for name in ("op11_importance_resampling", "op13_vector_codes"):
        made = queries.queries()[name](spark, sf_dir)
        columns = sorted(made.columns)
        wanted = con.sql(queries.oracle_sql()[name])
        assert sorted(wanted.columns) == columns
        assert sorted(map(str, (tuple(r) for r in made.select(*columns).collect()))) == sorted(map(str, wanted.select(*columns).fetchall()))
