"""Tokens against the library, packing and Huffman files by exact round trips."""

import hashlib
import random
import zlib

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
vocabularies = pytest.importorskip("public_tokenizers")

from tideglass.llm import huffman, packing  # noqa: E402
from tideglass.llm.bpe import TextEncoder, Vocabulary  # noqa: E402
from tideglass.llm.bpe_codec import token_digests  # noqa: E402
from tideglass.llm.common import new_path  # noqa: E402
from tideglass.llm.token_output import read_token_files, token_table, write_token_files  # noqa: E402

from .conftest import HARD  # noqa: E402

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def library(name):
    return tokenizers.Tokenizer.from_file(vocabularies.path(name))


@pytest.mark.parametrize("name", FILES)
def test_encoder(name):
    random.seed(7)
    near = "ab 's\n\t.1é́日<|>İß\x1c\x85 "
    far = [chr(c) for c in [*range(0x20, 0x250), *range(0x300, 0x2000, 7), *range(0x2000, 0x2070), *range(0x3000, 0x3100), *range(0x1F600, 0x1F610)]]
    texts = [t or "" for _, t in HARD] + ["".join(random.choice(a) for _ in range(random.randint(0, 40))) for a in (near, far) for _ in range(1500)]
    texts += ["'s't 's <|startoftext|>x", "ab" * 4000, "word " * 300_000]
    lib = library(name)
    for text, ids in zip(texts, TextEncoder(vocabularies.path(name)).encode_each(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids, text[:80]


def test_encoder_that_forgets():
    path = vocabularies.path(FILES[0])
    texts = [" ".join(str(x * x) + "ab" * (x % 9) for x in range(k, k + 400)) for k in range(0, 4000, 300)] + ["1\n" * 3000]
    assert [*TextEncoder(path, room=100).encode_each(texts, 2000)] == [*TextEncoder(path).encode_each(texts)]


def test_merges_without_proposals():
    m = TextEncoder(vocabularies.path(FILES[0])).merges
    words = [b" " + bytes(random.Random(k).choices(b"etaoinshr", k=k % 30 + 1)) for k in range(2000)] + [b"xy" * 200]
    body, given = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
    ids, sizes = m.encode(body, given)
    exact, counts = m._merge(*m._symbols(body, given))
    assert (ids == exact).all() and (sizes == counts).all()


def test_codec(documents, hard, empty):
    lib, path = library(FILES[0]), vocabularies.path(FILES[0])
    for df in (documents, hard):
        found = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in token_digests(df, path).collect())
        wanted = []
        for r in df.select("doc_id", "text").collect():
            ids = lib.encode(r.text or "", add_special_tokens=False).ids
            wanted.append((str(r.doc_id), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
        assert found == sorted(wanted)
    assert token_digests(empty, path).count() == 0


def test_vocabulary_of_words():
    v = Vocabulary(vocabularies.path(FILES[1]))
    assert v.decode(TextEncoder.of(vocabularies.path(FILES[1])).encode_batch(["Two words."])[0]).strip() == "two words ."


def check_packing(df, found, capacity=4096):
    lib = library(FILES[1])
    ids = [np.array(lib.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4") for r in df.select("text").collect()]
    assert sum(r.length for r in found) == sum(map(len, ids))
    crcs = {(len(x), 0, zlib.crc32(x.tobytes())) for x in ids}
    assert all((r.doc_tokens, r.start, r.ids_crc32) in crcs for r in found if r.length == r.doc_tokens)
    by = {}
    for r in found:
        by.setdefault(r.sequence_id, []).append(r)
    assert sorted(by) == list(range(len(by)))
    for rows in by.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by)


def test_only_left_pieces_reach_the_single_task(documents):
    plan = packing.pack_documents(documents, vocabularies.path(FILES[1]))._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce 1" not in plan and "Exchange SinglePartition, REPARTITION_BY_NUM" in plan


def test_packing(spark, documents, hard, empty):
    path = vocabularies.path(FILES[1])
    found = packing.pack_documents(documents, path).collect()
    n = check_packing(documents, found)
    assert n * 4096 - sum(r.length for r in found) < 0.02 * n * 4096
    lib = library(FILES[1])
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in found:
        ids = np.array(lib.encode(texts[r.doc_id], add_special_tokens=False).ids + [2], "<u4")
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    check_packing(hard, packing.pack_documents(hard, path).collect())
    assert packing.pack_documents(empty, path).count() == 0
    rows = packing.sequences(packing.pack_documents(documents, path, with_ids=True)).collect()
    assert all(len(r.ids) == 4 * r.length for r in rows)


def test_cuts():
    lengths = packing.reciprocal_lengths(4096)
    for n in [*range(1, 5000, 7), 4096, 8192, 10_000]:
        pieces = packing.cut(n, 4096, lengths)
        assert sum(pieces) == n and all(p in lengths for p in pieces) and len(pieces) <= n // 4096 + 5


@pytest.mark.parametrize("counts", [[1], [5, 0, 3], [1] * 7, [1 << k for k in range(40)], [1_000_000 // k for k in range(1, 50_001)], []])
def test_huffman(counts):
    c = np.array(counts, np.int64)
    for limit in (16, 20):
        lengths = huffman.code_lengths(c, limit)
        used = lengths[lengths > 0].astype(float)
        assert (lengths > 0).tolist() == (c > 0).tolist() and (not len(used) or used.max() <= limit)
        if len(used) > 1:
            assert (2.0**-used).sum() == pytest.approx(1)
    if len(used):
        codec, ids = huffman.Codec(lengths), np.random.default_rng(1).choice(np.flatnonzero(c), 5001).astype("<u4")
        for n in (0, 1, 511, 512, 513, 5001):
            raw, offsets = codec.pack(ids[:n], 512)
            assert (codec.unpack(raw, n, offsets, 512) == ids[:n]).all()


def test_optimal_lengths():
    import heapq

    c = np.random.default_rng(3).integers(1, 1000, 300)
    heap, cost = [int(x) for x in c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        s = heapq.heappop(heap) + heapq.heappop(heap)
        cost += s
        heapq.heappush(heap, s)
    assert int((huffman.code_lengths(c).astype(int) * c).sum()) == cost


def test_token_files(spark, documents, hard, empty):
    lib, path = library(FILES[0]), vocabularies.path(FILES[0])
    at = 0
    found = {r.doc_id: r for r in token_table(documents, path).collect()}
    for r in documents.orderBy("doc_id").collect():
        ids = np.array(lib.encode(r.text, add_special_tokens=False).ids + [0], "<u4")
        assert (found[r.doc_id].start, found[r.doc_id].n_tokens, found[r.doc_id].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    out = new_path(spark, "small-blocks")
    write_token_files(hard, path, out, block_ids=1000, every=16)
    rows = read_token_files(spark, out, every=16).orderBy("start").collect()
    assert [str(r.doc_id) for r in rows] == ["None"] * 2 + [str(k) for k in [*range(1, 13), 14, 14, 14]]
    wanted = sorted(lib.encode(t or "", add_special_tokens=False).ids + [0] for _, t in HARD)
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in rows) == wanted
    assert token_table(empty, path).count() == 0
