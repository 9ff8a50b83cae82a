"""SimHash near-dedup by multi-index hashing.

Two 64-bit fingerprints that differ in at most two bits differ in at most one bit of their upper halves, or not at all
in their lower halves. So there is a table by upper half, probed with the 33 values of the Hamming ball of radius one
around a fingerprint's upper half, and a table by lower half, probed with the lower half itself. What a probe fetches is
verified over all 64 bits.

Skew: tables hold distinct fingerprints only, so copies cost nothing. A table entry that more than BUCKET fingerprints
share (a large family of near copies) isn't probed; the fingerprints in such entries are linked among themselves through
the 65 points of their whole radius-one balls. Two of them within two bits share such a point, and at most 65
fingerprints share one, so this takes 65 rows for each fingerprint however large the family is, and loses no link.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideglass.llm.common import small_batches, written
from tideglass.llm.components import components

BUCKET = 16
_SEED = 42  # a fixed value of the fingerprint
_BLOCK = 1 << 20  # bytes of a text taken into words at once
_FULL = "transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i))"
_SPACE = b" \t\n\x0b\x0c\r"


def _word_blocks(raw: bytes):
    """Lists of words of bounded size, in order."""
    at, n = 0, len(raw)
    while at < n:
        end = at + _BLOCK
        while end < n and raw[end] not in _SPACE:
            end += 1
        yield raw[at:end].split()
        at = end


def fingerprint(text: str | None, width: int = 3) -> int:
    """The SimHash of one text over shingles of so many words, as an unsigned integer."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    counts, total, carry = np.zeros(64, np.int64), 0, []
    for words in _word_blocks(raw):
        words = carry + words
        shingles = [*map(b" ".join, zip(*(words[i:] for i in range(width))))]
        carry = words[-(width - 1) :] if width > 1 else []
        for k in range(0, len(shingles), 1 << 16):
            part = shingles[k : k + (1 << 16)]
            h = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(_SEED)), np.uint64, len(part))
            counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += len(part)
    if not total and carry:
        h = np.array([xxhash.xxh64_intdigest(b" ".join(carry), _SEED)], np.uint64)
        counts, total = np.unpackbits(h.view(np.uint8), bitorder="little").astype(np.int64), 1
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0]) if total else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fp): fp as a signed long. Null texts count as empty; empty ones have fingerprint 0.

    One row for each row of docs, null and repeated ids included; other columns are not read; an empty table gives none.
    """

    def run(batches):
        for b in batches:
            made = np.array([fingerprint(t.as_py(), width) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made)], ["doc_id", "fp"])

    return small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(run, "doc_id long, fp long")


def near_links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(a, b): enough links between distinct fingerprints (column fp) at two bits or fewer to connect all such pairs."""
    halves = "inline(array(struct(0 as seg, shiftrightunsigned(fp, 32) as key), struct(1 as seg, fp & 4294967295L as key)))"
    table = fps.selectExpr("fp", halves)
    crowded = table.groupBy("seg", "key").count().filter(F.col("count") > bucket).select("seg", "key")
    crowded = written(crowded, "crowded")
    ball = (
        "inline(concat(array(struct(0 as seg, shiftrightunsigned(fp, 32) as key), struct(1 as seg, fp & 4294967295L as key)),"
        " transform(sequence(0, 31), i -> struct(0 as seg, shiftrightunsigned(fp, 32) ^ shiftleft(1L, i) as key))))"
    )
    probes = fps.selectExpr("fp as a", "fp").selectExpr("a", ball)
    entries = table.join(crowded, ["seg", "key"], "left_anti").withColumnRenamed("fp", "b")
    light = probes.join(entries, ["seg", "key"]).filter("a <> b and bit_count(a ^ b) <= 2").select("a", "b")
    dense = written(table.join(crowded, ["seg", "key"], "left_semi").select("fp").distinct(), "dense")
    points = dense.selectExpr("fp", f"explode(concat(array(fp), {_FULL})) as point")
    hubs = points.groupBy("point").agg(F.min("fp").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    heavy = points.join(hubs, "point").filter("fp <> hub and bit_count(fp ^ hub) <= 2").select(F.col("fp").alias("a"), F.col("hub").alias("b"))
    return light.union(heavy).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """For each row of docs: doc_id, fingerprint (16 hex digits), component_id (least doc_id linked to it by a chain).

    Rows that repeat an id are one document for the component and one row each in the result. A null id takes part with
    its fingerprint but is nobody's component_id unless its whole component has no other. Other columns are not read.
    An empty table gives an empty result.
    """
    made = written(fingerprints(docs, id_col, text_col), "fingerprints")
    fps = written(made.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    links = written(near_links(fps.select("fp"), bucket), "links")
    # fingerprints are the nodes, so that those of null ids link others; those of one least document belong together
    shared = fps.filter("rep is not null").groupBy("rep").agg(F.min("fp").alias("src"), F.max("fp").alias("most")).filter("src < most")
    same = fps.join(shared, "rep").filter("fp <> src").select("src", F.col("fp").alias("dst"))
    labels = components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(same))
    rooted = written(fps.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", F.coalesce("label", "fp").alias("root")), "rooted")
    of_fp = rooted.join(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "root").select("fp", "component_id")
    return made.join(of_fp, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
