"""BPE encoding and decoding of whole texts (see bpe.py for the method)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideglass.llm.bpe import TextEncoder, Vocabulary
from tideglass.llm.common import release_memory, small_batches

#: Bytes of a batch that a task hands on at once.
_OUT = 4 << 20


def in_batches(rows, types: dict[str, pa.DataType]):
    """Record batches of bounded size from (size, row) pairs."""
    cols, size = [[] for _ in types], 0
    make = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types.values(), strict=True)], [*types])
    for n, row in rows:
        for c, v in zip(cols, row, strict=True):
            c.append(v)
        size += n
        if size >= _OUT:
            yield make()
            cols, size = [[] for _ in types], 0
    yield make()
    cols.clear()
    release_memory()  # workers live on, and others share the executor's memory


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of each whole text as little-endian unsigned 32-bit integers.

    They equal those of the library that the vocabulary file belongs to, without added special tokens; the strings of
    special tokens in a text give their ids. A null text counts as empty and gives no ids, one row for each row of docs.
    Workers remember a bounded number of distinct pieces; batches are worked on in bounded groups, and long texts in blocks
    that end at a blank: a stretch without any is one block. Null and repeated ids each give their row; other columns are
    not read. An empty table gives an empty result.
    """

    def run(batches):
        encoder = TextEncoder.of(path)

        def rows():
            for b in batches:
                texts = (t.as_py() or "" for t in b.column(1))
                for doc, ids in zip(b.column(0).to_pylist(), encoder.encode_each(texts), strict=True):
                    yield len(ids) + 8, (doc, ids)

        yield from in_batches(rows(), {"doc_id": pa.int64(), "ids": pa.binary()})

    return small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, ids binary")


def decode_documents(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text): tokens with the text that its ids stand for, special tokens included; broken UTF-8 is replaced.

    Null ids give an empty text. Rows may repeat and the table be empty; other columns are left out.
    """

    def run(batches):
        vocabulary = Vocabulary(path)

        def rows():
            for b in batches:
                for doc, ids in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    raw = ids.as_py() or b""
                    yield 2 * len(raw) + 8, (doc, raw, vocabulary.decode(raw))

        yield from in_batches(rows(), {"doc_id": pa.int64(), "ids": pa.binary(), "text": pa.string()})

    return tokens.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256, after encoding and decoding back.

    Null and empty texts have no ids and an empty decoded text; null and repeated ids each keep their row; other columns
    are not read. An empty table gives an empty result.
    """
    return decode_documents(encode_documents(docs, path), path).select(
        "doc_id", F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256")
    )
