"""Vector codes against plain versions that compare every part with every entry."""

import hashlib
import math

import numpy as np
import pytest

from tideglass.llm.vector_codes import Codebook, code_table, decode_vectors, encode_vectors, fit_codebooks, integer_vectors


def plain(rows, parts=8, entries=16, rounds=6):
    """rows: (id, vector, label)."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], "<i4").tobytes()))
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    near = lambda v, p: min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e, strict=True)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            own = [[] for _ in books[p]]
            for _, v, _ in kept:
                own[near(v, p)[1]].append(cut(v, p))
            new.append([[sum(c) // len(o) for c in zip(*o, strict=True)] if o else e for o, e in zip(own, books[p], strict=True)])
        books = new
    found = [(i, [near(v, p) for p in range(parts)], label) for i, v, label in kept]
    total = {}
    for _, ds, label in found:
        total[label] = total.get(label, 0) + sum(d for d, _ in ds)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, "".join(f"{k:02x}" for _, k in ds), sum(d for d, _ in ds), total[label], digest) for i, ds, label in found]


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


def test_equals_plain(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assert ordered(code_table(df).collect()) == ordered(plain([tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]))


def test_hard_table(spark):
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=16).tolist(), k % 3 if k % 4 else None) for k in range(60)]
    rows += [(3, rows[3][1], 0), (3, rows[5][1], 1), (None, rows[7][1], None), (None, [0.0] * 16, 2), (61, None, 1), (62, [], 1), (63, [None] + [1.0] * 15, 1), (64, [float("nan")] * 16, 1), (65, [float("inf")] + [0.0] * 15, 1)]
    rows += [(k, [0.5] * 16, 9) for k in range(100, 160)]
    df = spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], "vec_id long, embedding array<float>, label int, code string, vector int").repartition(3)
    as_stored = [(i, v and [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    assert ordered(code_table(df).collect()) == ordered(plain(as_stored))
    assert code_table(df.limit(0)).count() == 0 and code_table(df.filter("vec_id in (61, 64)")).count() == 0
    assert ordered(code_table(df.filter("vec_id < 5")).collect()) == ordered(plain([r for r in as_stored if r[0] is not None and r[0] < 5]))  # fewer than entries
    with pytest.raises(Exception, match="length"):
        code_table(spark.createDataFrame([(1, [1.0] * 16, 1), (2, [1.0] * 8, 1)], "vec_id long, embedding array<float>, label int")).collect()


def test_masks_hold_the_nearest():
    rng = np.random.default_rng(6)
    for entries, width, spread in ((1, 4, 9), (16, 8, 1000), (64, 3, 4), (16, 1, 3)):
        book, x = Codebook(rng.integers(-spread, spread, (entries, width))), rng.integers(-2 * spread, 2 * spread, (3000, width))
        d = ((x[:, None] - book.entries[None]) ** 2).sum(axis=2)
        code, best = book.nearest(x)
        assert (code == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
        radius = np.full(len(x), spread // 2)
        inside = (np.abs(x[:, None] - book.entries[None]) <= radius[:, None, None]).all(axis=2)
        masks = book.candidates(x, radius)
        assert all(((masks >> np.uint64(e) & np.uint64(1)) == inside[:, e]).all() for e in range(entries))
    with pytest.raises(ValueError):
        Codebook(np.zeros((65, 2)))


def test_decoded_vectors_are_near(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vectors = integer_vectors(df, "embedding")
    books = fit_codebooks(vectors, "vec_id", "embedding")
    back = decode_vectors(encode_vectors(vectors, "embedding", books), books).join(df.select("vec_id", "embedding"), "vec_id")
    for r in back.collect():
        whole = np.floor(4096 * np.array(r.embedding, np.float64))
        assert int(((whole - 4096 * np.array(r.vector)) ** 2).sum()) == r.error
