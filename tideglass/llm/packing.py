"""Harmonic packing of tokenised documents into sequences.

A sequence holds CAPACITY tokens. Class k takes pieces of the reciprocal length CAPACITY // k, k to a sequence. A document
gives full sequences first; from what is left, the longest reciprocal length that fits is cut off, again and again. The
rest shrinks with the square of itself, so there are few cuts, and below the square root of CAPACITY each length is one
of the classes. Pieces of a class are counted in each task; prefix sums of those counts number them over all tasks, and
each full run of k makes a sequence, so tasks fill sequences without knowing of each other. What remains in all classes,
fewer than k pieces each, is at most about 22,000 pieces whatever the input's size; these are packed best fit, longest
first, in one task.
"""

from __future__ import annotations

import bisect
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideglass.llm.bpe import TextEncoder
from tideglass.llm.bpe_codec import in_batches
from tideglass.llm.common import small_batches, written

CAPACITY = 4096
END_ID = 2
_PIECE = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(), "class": pa.int64(), "part": pa.int64(), "local": pa.int64(), "ids": pa.binary()}
_KEYS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]


def reciprocal_lengths(capacity: int) -> list[int]:
    """All capacity // k, ascending."""
    return sorted({capacity // k for k in range(1, capacity + 1)})


def cut(n: int, capacity: int, lengths: list[int]) -> list[int]:
    """The lengths of the pieces of a document of n tokens."""
    pieces = [capacity] * (n // capacity)
    n %= capacity
    while n:
        pieces.append(lengths[bisect.bisect_right(lengths, n) - 1])
        n -= pieces[-1]
    return pieces


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all documents with their class and their number within class and task.

    A null or empty text is the end id alone; null and repeated ids each give their pieces; other columns are not read. An
    empty table gives no pieces.
    """
    lengths = reciprocal_lengths(capacity)

    def run(batches):
        encoder, part, seen = TextEncoder.of(path), TaskContext.get().partitionId(), {}
        end = end_id.to_bytes(4, "little")

        def rows():
            for b in batches:
                texts = (t.as_py() or "" for t in b.column(1))
                for doc, ids in zip(b.column(0).to_pylist(), encoder.encode_each(texts), strict=True):
                    ids += end
                    at, n = 0, len(ids) // 4
                    for length in cut(n, capacity, lengths):
                        own = ids[4 * at : 4 * (at + length)]
                        k = capacity // length
                        local = seen[k] = seen.get(k, -1) + 1
                        yield 64 + len(own) * with_ids, (doc, at, length, zlib.crc32(own), n, k, part, local, own if with_ids else None)
                        at += length

        yield from in_batches(rows(), _PIECE)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class long, part long, local long, ids binary"
    return small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def _best_fit(capacity: int, first_id: int):
    """Packs all rows of one partition: longest first, each where least room is left over."""

    def run(frames):
        import pandas as pd

        if not (parts := [*frames]):
            return
        rows = pd.concat(parts)
        rows = rows.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable")
        room: list[tuple[int, int]] = []  # (tokens free, sequence), ascending
        ids, offsets, made = [], [], 0
        for n in rows["length"]:
            k = bisect.bisect_left(room, (n, -1))
            free, seq = room.pop(k) if k < len(room) else (capacity, made)
            made += seq == made
            ids.append(first_id + seq)
            offsets.append(capacity - free)
            if free > n:
                bisect.insort(room, (free - n, seq))
        yield rows.assign(sequence_id=ids, offset=offsets)

    return run


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if asked for).

    A document's ids are those of its whole text, then end_id; a null text counts as empty. start counts the document's
    ids before the piece, doc_tokens all of them with end_id. Each row of docs is packed, repeated ones too; null ids
    stay null. Sequences are numbered from 0 without gaps, offsets in one run from 0 without gaps. An empty table gives
    an empty result. Other columns are not read.
    """
    pieces = written(pieces_of(docs, path, capacity, end_id, with_ids, id_col, text_col), "pieces")
    counts = pieces.groupBy("class", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(counts.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "bases")
    # one row a class: at most 2 * sqrt(capacity) rows
    before = Window.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    full = bases.groupBy("class").agg(F.expr("sum(n) div class").alias("full"))
    full = full.withColumn("first", F.coalesce(F.sum("full").over(before), F.lit(0)))
    total = written(full, "classes")
    first_id = total.agg(F.sum("full")).first()[0] or 0
    numbered = pieces.join(bases.select("class", "part", "base"), ["class", "part"]).join(F.broadcast(total), "class").withColumn("index", F.col("base") + F.col("local"))
    keys = _KEYS + ["ids"] * with_ids
    in_full = F.expr("index div class") < F.col("full")
    filled = numbered.filter(in_full).select(*keys, (F.col("first") + F.expr("index div class")).alias("sequence_id"), (F.pmod("index", "class") * F.col("length")).alias("offset"))
    # a shuffle, so that only these rows come to the one task and not the scan before the filter
    left = numbered.filter(~in_full).select(*keys).repartition(1)
    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return filled.unionByName(left.mapInPandas(_best_fit(capacity, first_id), f"{kinds}, sequence_id long, offset long"))


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, length): the token ids of each sequence, from pieces packed with their ids.

    Pieces of null and repeated doc_ids count like any; no pieces give no sequences.
    """
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # at most capacity tokens
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), inside.alias("p")).select("sequence_id", F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"), "length")
