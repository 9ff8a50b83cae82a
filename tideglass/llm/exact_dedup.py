"""Exact dedup over an extendible-hash index of normalised texts.

A directory maps leading hash bits to buckets; it starts at the depth that the key count asks for, and while buckets are
overfull those are split by one more bit each (the directory doubles when a bucket is as deep as the directory). The
index holds a small entry for each distinct text (hash, size, digest, rows, greatest id), no text. Entries go to files on
the shared folder in (bucket, key) ranges, so that one task owns all entries of a key; it chains those that collide,
numbering the key's links by size and digest. For links of more than one row the texts are read again and compared byte
by byte (least against greatest); texts that differ under one digest part into links of their own. Rows then look up
their link by directory cell, key, size and digest. Everything is DataFrame code.

Skew: copies of one text share one key, and no directory depth can split them. They are counted, and their least and
greatest text are taken, within each task before anything is shuffled, so that a text is one entry however many copies
it has.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideglass.llm.common import ascii_lower, drop_written, key_filter, maybe_in, text_of, without, written

#: Distinct keys that a bucket may hold.
CAPACITY = 1 << 14


def directory(keys: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(cell, bucket, depth): the buckets of distinct keys (column key) by leading bits.

    cell counts from 0 to 2**g - 1, where g is the greatest depth; all cells of a shallower bucket name that bucket.
    bucket is its lowest cell, so buckets ascend with the keys. An empty table has one bucket of depth 0.
    """
    spark, n = keys.sparkSession, keys.count()
    depth = max(0, math.ceil(math.log2(max(1, n) / capacity)))
    # a shift by 64 is one by 0 on the JVM, so depth 0 needs its own constant
    lead = lambda d: F.shiftrightunsigned("key", 64 - d) if d else F.lit(0).cast("long")
    level = written(keys.groupBy(lead(depth).alias("prefix")).agg(F.count("*").alias("n")), "directory")
    buckets = [(level.filter(F.col("n") <= capacity), depth)]
    while depth < 63:
        full = level.filter(F.col("n") > capacity).select("prefix")
        if full.isEmpty():
            break
        split = keys.withColumn("prefix", lead(depth)).join(full, "prefix", "left_semi").select("key")
        depth += 1
        level = written(split.groupBy(lead(depth).alias("prefix")).agg(F.count("*").alias("n")), "directory")
        buckets.append((level.filter(F.col("n") <= capacity) if depth < 63 else level, depth))
    cells = spark.createDataFrame([], "cell long, bucket long, depth int")
    for rows, d in buckets:
        first = F.shiftleft("prefix", depth - d)
        cells = cells.unionByName(
            rows.select(
                F.explode(F.sequence(first, first + ((1 << (depth - d)) - 1))).alias("cell"), first.alias("bucket"), F.lit(d).alias("depth")
            )
        )
    return cells.select("cell", "bucket", "depth", F.lit(depth).alias("directory_depth"))


def _hash(norm: Column) -> Column:
    return F.xxhash64(norm)


def _digest(norm: Column) -> Column:
    return F.sha2(norm, 256)


def _entries(docs: DataFrame, id_col: str, text_col: str, key, digest) -> DataFrame:
    norm = ascii_lower(text_of(docs, text_col))
    return written(docs.select(F.col(id_col).alias("id"), key(norm).alias("key"), F.octet_length(norm).cast("long").alias("n_bytes"), digest(norm).alias("text_sha256")), "entries")


def _placed(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """rows with the bucket that the directory names for their key."""
    depth = (cells.agg(F.max("directory_depth")).first() or [0])[0] or 0
    cell = F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")
    return rows.withColumn("cell", cell).join(cells.select("cell", "bucket"), "cell").drop("cell")


def build_index(entries: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame]:
    """(directory, index) of entries (id, key, n_bytes, text_sha256), as read from their files.

    The index has (bucket, key, link, n_bytes, text_sha256, n, keep) for each distinct text: how many rows have it, and
    the greatest of their ids. link numbers the texts of a key from 1.
    """
    texts = written(entries.groupBy("key", "n_bytes", "text_sha256").agg(F.count("*").alias("n"), F.max("id").alias("keep")), "texts")
    cells = written(directory(texts.select("key").distinct(), capacity), "cells")
    chain = Window.partitionBy("bucket", "key").orderBy("n_bytes", "text_sha256")
    # the owner of a range has all entries of its keys: the window needs no further shuffle
    owned = _placed(texts, cells).repartitionByRange("bucket", "key").withColumn("link", F.row_number().over(chain))
    index = written(owned.select("bucket", "key", "link", "n_bytes", "text_sha256", "n", "keep"), "index")
    drop_written(texts)
    return cells, index


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, key=_hash, digest=_digest) -> DataFrame:
    """For each row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text equals an empty one. Of equal texts the row with
    the largest id stays. Rows that repeat an id with an equal text count in group_size each and share their flags.
    A null id loses against any other; a group of nulls only keeps them all. Other columns of docs are not read.
    An empty table gives an empty result. key and digest hash a text for the index; whatever they are, only equal bytes
    make a group.
    """
    entries = _entries(docs, id_col, text_col, key, digest)
    cells, index = build_index(entries, capacity)
    several = index.filter("n > 1")
    norm = ascii_lower(text_of(docs, text_col))
    texts = docs.select(F.col(id_col).alias("id"), norm.alias("norm"), key(norm).alias("key"))
    suspects = maybe_in(texts, "key", key_filter(several.select("key"), "key")).withColumn("text_sha256", digest(F.col("norm")))
    sizes = F.octet_length("norm").cast("long").alias("n_bytes")
    compared = suspects.groupBy("key", sizes, "text_sha256").agg(F.min("norm").alias("least"), F.max("norm").alias("greatest"))
    whole = written(compared.select("key", "n_bytes", "text_sha256", (F.col("least") == F.col("greatest")).alias("equal")), "compared")
    link = ["key", "n_bytes", "text_sha256"]
    links = written(several.join(whole.filter("equal"), link).select("bucket", *link, "n", "keep"), "links")
    of_rows = lambda rows, n, keep: rows.select(
        F.col("id").alias("doc_id"), F.when(n.isNull(), F.col("id")).otherwise(keep).alias("keep_id"), F.coalesce(n, F.lit(1)).cast("long").alias("group_size"), "text_sha256"
    )
    looked_up, more = entries, []
    if not (unlike := whole.filter("not equal").select(*link)).isEmpty():
        # different texts under one digest: their rows are told apart by the texts themselves
        apart = suspects.withColumn("n_bytes", sizes).join(unlike, link, "left_semi")
        own = apart.groupBy(*link, "norm").agg(F.count("*").alias("n"), F.max("id").alias("keep"))
        more.append(of_rows(apart.join(own, [*link, "norm"]), F.col("n"), F.col("keep")))
        looked_up = entries.join(unlike, link, "left_anti")
    found = _placed(looked_up, cells).join(links, ["bucket", *link], "left")
    result = of_rows(found, F.col("n"), F.col("keep"))
    for rows in more:
        result = result.unionByName(rows)
    return result.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """docs without the rows that exact_dedup doesn't keep, all columns as they are; a row without id always stays."""
    gone = exact_dedup(docs, id_col, text_col, capacity).filter(~F.col("kept")).select("doc_id", "text_sha256")
    return without(docs, gone, [F.col(id_col), F.sha2(ascii_lower(text_of(docs, text_col)), 256)])
