"""Token ids as binary files under a canonical length-limited Huffman code.

Texts are encoded where they lie and kept once as plain ids, two bytes each if the vocabulary allows. Their counts are one
grouped sum; at most one row for each id of the vocabulary comes to the driver, and the code lengths that follow make the
codebook. Then documents' ids, not their texts, are dealt to ascending ranges of doc_id (parts) and coded in blocks: the
bits of BLOCK_IDS ids at most, and its bit offset at every EVERY-th id. Decoding needs a block and the codebook alone; it
looks words up in a table and goes on from all checkpoints of a block at once.

Format of a directory: `codebook` (id, bits), and `blocks` in one folder a part, with block, n_ids, payload, checkpoints
and docs: for each document in the block its doc_id, its rank in the part, the ids of the part before it, all its ids,
and how many of them stand in earlier blocks and in this one. Parts ascend in doc_id, and so do ranks and blocks within.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideglass.llm.bpe import TextEncoder, Vocabulary
from tideglass.llm.bpe_codec import in_batches
from tideglass.llm.common import drop_written, new_path, small_batches, written
from tideglass.llm.huffman import LIMIT, Codec, code_lengths

END_ID = 0
BLOCK_IDS = 1 << 20
EVERY = 512
_DOC = ["doc_id", "rank", "before", "n_tokens", "done", "here"]
_DOCS = pa.list_(pa.struct([(k, pa.int64()) for k in _DOC]))
_DOCS_SQL = f"docs array<struct<{', '.join(f'{k}: long' for k in _DOC)}>>"
_CODED = {"part": pa.int64(), "block": pa.int64(), "n_ids": pa.int64(), "payload": pa.binary(), "checkpoints": pa.list_(pa.int64()), "docs": _DOCS}


def plain_ids(docs: DataFrame, path: str, kind: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): each text's ids with end_id behind them, as integers of the given kind; null counts as empty."""
    tail = np.array([end_id], kind).tobytes()

    def run(batches):
        encoder = TextEncoder.of(path)

        def rows():
            for b in batches:
                texts = (t.as_py() or "" for t in b.column(1))
                for doc, ids in zip(b.column(0).to_pylist(), encoder.encode_each(texts), strict=True):
                    own = np.frombuffer(ids, "<u4").astype(kind).tobytes() + tail
                    yield len(own) + 8, (doc, own)

        yield from in_batches(rows(), {"doc_id": pa.int64(), "ids": pa.binary()})

    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary")


def _blocks(rows, size_of: int, block_ids: int):
    """(block, ids, documents inside) from (doc_id, ids) in order; only a document longer than a block runs over several."""
    block = rank = before = size = 0
    raw, inside = [], []
    for doc, ids in rows:
        n, at = len(ids) // size_of, 0
        if size and size + n > block_ids:
            yield block, b"".join(raw), inside
            block, size, raw, inside = block + 1, 0, [], []
        while at < n:
            here = min(n - at, block_ids - size)
            raw.append(ids[size_of * at : size_of * (at + here)])
            inside.append(dict(zip(_DOC, (doc, rank, before, n, at, here), strict=True)))
            at, size = at + here, size + here
            if size == block_ids:
                yield block, b"".join(raw), inside
                block, size, raw, inside = block + 1, 0, [], []
        rank, before = rank + 1, before + n
    if size:
        yield block, b"".join(raw), inside


def id_counts(ids: DataFrame, kind: str) -> np.ndarray:
    """How often each id occurs in (doc_id, ids)."""

    def count(batches):
        n = np.zeros(0, np.int64)
        for b in batches:
            own = np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), kind), minlength=len(n))
            own[: len(n)] += n
            n = own
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(n[used], pa.int64())], ["id", "n"])

    counts = ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()  # a row an id
    n = np.zeros(int(counts["id"].max()) + 1 if len(counts) else 1, np.int64)
    n[counts["id"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    return n


def write_token_files(docs: DataFrame, path: str, out: str, limit: int = LIMIT, end_id: int = END_ID, block_ids: int = BLOCK_IDS, every: int = EVERY, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the ids of all documents, each with end_id behind it, below the folder `out`.

    A null text counts as empty, so each row has at least one id. Null doc_ids come first; rows that repeat a doc_id
    stand next to each other. An empty table gives files without rows. Other columns are not read.
    """
    spark = docs.sparkSession
    kind = "<u2" if max(len(Vocabulary(path).of_id), end_id + 1) <= 1 << 16 else "<u4"
    kept = written(plain_ids(docs, path, kind, end_id, id_col, text_col), "ids", "zstd")
    lengths = code_lengths(id_counts(kept, kind), limit)
    book = [(int(k), int(lengths[k])) for k in np.flatnonzero(lengths)]
    spark.createDataFrame(book, "id long, bits int").coalesce(1).write.parquet(f"{out}/codebook")
    width = np.dtype(kind).itemsize

    def encode(batches):
        codec, part = Codec(lengths), TaskContext.get().partitionId()
        documents = ((doc, ids.as_py()) for b in batches for doc, ids in zip(b.column(0).to_pylist(), b.column(1), strict=True))

        def rows():
            for block, ids, inside in _blocks(documents, width, block_ids):
                own = np.frombuffer(ids, kind).astype("<u4")
                payload, offsets = codec.pack(own, every)
                yield len(payload) + 8 * len(offsets) + 48 * len(inside), (part, block, len(own), payload, offsets, inside)

        yield from in_batches(rows(), _CODED)

    # rows that share an id may be dealt to several parts
    placed = kept.withColumn("place", F.xxhash64(F.monotonically_increasing_id()))
    ordered = placed.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place")
    coded = ordered.select("doc_id", "ids").mapInArrow(encode, f"part long, block long, n_ids long, payload binary, checkpoints array<long>, {_DOCS_SQL}")
    coded.write.partitionBy("part").option("compression", "none").parquet(f"{out}/blocks")
    drop_written(kept)


def read_token_files(spark: SparkSession, out: str, every: int = EVERY) -> DataFrame:
    """(doc_id, start, ids): each document's ids as 32-bit integers, and how many ids all documents before it have.

    One row for each written one, null and repeated doc_ids included; files without rows give none. A document that runs
    over several blocks is put together again.
    """
    schema = f"block long, n_ids long, payload binary, checkpoints array<long>, {_DOCS_SQL}, part long"
    blocks = spark.read.schema(schema).parquet(f"{out}/blocks")
    # one row for each id that occurs: at most the vocabulary
    book = spark.read.schema("id long, bits int").parquet(f"{out}/codebook").toPandas()
    lengths = np.zeros(int(book["id"].max()) + 1 if len(book) else 1, np.uint8)
    lengths[book["id"].to_numpy(np.int64)] = book["bits"].to_numpy(np.uint8)

    def decode(batches):
        codec = Codec(lengths)

        def rows():
            for b in batches:
                for part, n, payload, offsets, inside in zip(*(b.column(k) for k in range(5)), strict=True):
                    ids, at = codec.unpack(payload.as_py(), n.as_py(), offsets.values.to_numpy(), every).astype("<u4").tobytes(), 0
                    for d in inside.as_py():
                        own = ids[4 * at : 4 * (at + d["here"])]
                        at += d["here"]
                        yield len(own) + 56, (part.as_py(), *(d[k] for k in _DOC), own)

        yield from in_batches(rows(), {"part": pa.int64()} | {k: pa.int64() for k in _DOC} | {"ids": pa.binary()})

    read = lambda rows: rows.select("part", "n_ids", "payload", "checkpoints", "docs").mapInArrow(decode, f"part long, {', '.join(f'{k} long' for k in _DOC)}, ids binary")
    whole = read(blocks).filter("here = n_tokens").select("part", "doc_id", "before", "ids")
    # blocks with a part of a longer document, few if any, are decoded once more
    cut = read(blocks.filter(F.exists("docs", lambda d: d["here"] < d["n_tokens"]))).filter("here < n_tokens").groupBy("part", "rank").agg(F.first("doc_id").alias("doc_id"), F.first("before").alias("before"), F.sort_array(F.collect_list(F.struct("done", "ids"))).alias("p"))
    joined = cut.select("part", "doc_id", "before", F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"))
    # a row a part
    sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return whole.unionByName(joined).join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "ids")


def token_table(docs: DataFrame, path: str) -> DataFrame:
    """Writes the files to the shared folder and, from what is read back, returns doc_id, start, n_tokens, ids_crc32.

    Nulls, repeated ids and empty tables are treated as write_token_files says: one row for each row of docs.
    """
    out = new_path(docs.sparkSession, "tokens")
    write_token_files(docs, path, out)
    return read_token_files(docs.sparkSession, out).select("doc_id", "start", F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
