"""SentencePiece encoding and decoding of whole texts (see pieces.py for the method)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideglass.llm.bpe_codec import in_batches
from tideglass.llm.common import small_batches
from tideglass.llm.pieces import PieceEncoder


def encode_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of each whole text, with begin and end, as little-endian unsigned 32-bit integers.

    They equal those of the library that the model file belongs to, without sampling. A null or empty text has begin and
    end only. One row for each row of docs, repeated and null ids included; other columns play no part.
    """

    def run(batches):
        encoder = PieceEncoder.of(path)

        def rows():
            for b in batches:
                texts = (t.as_py() or "" for t in b.column(1))
                for doc, ids in zip(b.column(0).to_pylist(), encoder.encode_each(texts), strict=True):
                    yield len(ids) + 8, (doc, ids)

        yield from in_batches(rows(), {"doc_id": pa.int64(), "ids": pa.binary()})

    return small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, ids binary")


def decode_pieces(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text): tokens with the text of their ids, as the library decodes them; null ids give an empty text.

    Rows may repeat, ids be null, and tables be empty; other columns are left out.
    """

    def run(batches):
        pieces = PieceEncoder.of(path).pieces

        def rows():
            for b in batches:
                for doc, ids in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    raw = ids.as_py() or b""
                    yield 2 * len(raw) + 8, (doc, raw, pieces.decode(raw))

        yield from in_batches(rows(), {"doc_id": pa.int64(), "ids": pa.binary(), "text": pa.string()})

    return tokens.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def piece_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256, after encoding and decoding back; see encode_pieces for nulls and repeats."""
    return decode_pieces(encode_pieces(docs, path), path).select(
        "doc_id", F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256")
    )
