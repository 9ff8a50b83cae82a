"""Sentence pieces against the library."""

import hashlib
import random

import numpy as np
import pytest

sentencepiece = pytest.importorskip("sentencepiece")
vocabularies = pytest.importorskip("public_tokenizers")

from tideglass.llm.piece_codec import decode_pieces, encode_pieces, piece_digests  # noqa: E402
from tideglass.llm.pieces import PieceEncoder  # noqa: E402

from .conftest import HARD  # noqa: E402

PATH = vocabularies.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def encoder():
    return PieceEncoder.of(PATH)


def test_encoder(library, encoder):
    random.seed(11)
    alphabets = ["ab 's\n\t.1é́日<|>İß\x1c\x85▁ ", "etaoinshrdlu ETH", "  a\n▁", [chr(c) for c in [*range(0x20, 0x250), *range(0x300, 0x3100, 5), *range(0xAC00, 0xAC80), *range(0x1F600, 0x1F610)]]]
    texts = [t or "" for _, t in HARD] + ["".join(random.choice(a) for _ in range(random.randint(0, 40))) for a in alphabets for _ in range(1500)]
    texts += ["<s>a</s><unk><0x0A>", " " * 777, "ab" * 4000, "日本" * 3000, "word " * 100_000]
    for text, ids in zip(texts, encoder.encode_each(texts), strict=True):
        wanted = library.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(ids, "<u4").tolist() == wanted, text[:80]
        assert encoder.pieces.decode(ids) == library.decode(wanted), text[:80]


def test_one_piece_ends_each_prefix(encoder):
    pieces = encoder.pieces
    for word in (" unbelievable", "thouinor", "        x", " ,,,..", "aaaaaaaaaaaaaaaaaaaa"):
        last = pieces.last_pieces(word)
        for n in range(1, len(word) + 1):
            assert pieces.text[last[n]] == pieces.merge([*word[:n]])[-1]


def test_decoding_of_any_ids(library, encoder):
    random.seed(12)
    for _ in range(3000):
        ids = [random.choice([random.randrange(32_000), random.randrange(300), 29871]) for _ in range(random.randrange(9))]
        assert encoder.pieces.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids), ids


def test_encoder_that_forgets(encoder):
    texts = [" ".join(str(x * x) + "ab" * (x % 9) for x in range(k, k + 400)) for k in range(0, 4000, 300)] + ["1\n" * 3000]
    assert [*PieceEncoder(PATH, room=100).encode_each(texts, 2000)] == [*encoder.encode_each(texts)]


def test_codec(documents, hard, empty, library):
    for df in (documents, hard):
        found = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in piece_digests(df, PATH).collect())
        wanted = []
        for r in df.select("doc_id", "text").collect():
            ids = library.encode(r.text or "", add_bos=True, add_eos=True)
            wanted.append((str(r.doc_id), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
        assert found == sorted(wanted)
    assert piece_digests(empty, PATH).count() == 0


def test_texts_come_back(spark, hard):
    back = decode_pieces(encode_pieces(hard, PATH), PATH)
    assert sorted(r.text for r in back.collect()) == sorted(r.text or "" for r in hard.select("text").collect())
    assert decode_pieces(spark.createDataFrame([(1, None), (None, b"")], "doc_id long, ids binary"), PATH).select("text").collect() == [("",), ("",)]
