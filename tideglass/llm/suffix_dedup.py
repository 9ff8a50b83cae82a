"""Removal of repeated byte strings by sorting sampled suffixes in range-partitioned buckets.

A string of SIZE bytes is repeated if it also starts earlier (in a document of smaller id, or earlier in its own). Not all
suffixes are sorted. In each string of SIZE bytes the GRAM bytes of least hash are its anchor; equal strings have equal
anchors at equal places, so it is enough to compare the suffixes that start at anchors, with the stretch of strings that
share an anchor as their context. A suffix has two leading tokens: the hash of what all strings of the stretch contain
(its core) and the hash of all that they cover (its context).

Suffixes are dealt to buckets by splitters sampled over (core, context, document, place); as the place is part of the
order, a token that fills a third of all rows is cut into many buckets. Their number follows the number of suffixes, so a
bucket's size is bounded. Each bucket is sorted by itself, by multikey quicksort. Of equal contexts all but the first are repeated in full. A context that is first
but shares its core with others is undecided; contexts that share their core with none drop out. What the first and last
core of a bucket need to know of its neighbours comes from one table with two rows a bucket.

Undecided stretches are cut into runs of STEP strings, and those still undecided into single strings, each time sorted in
the same way; so only the ends of repeated passages are looked at string by string. Tokens are 64-bit hashes, two for
each comparison, by different bases; equal tokens count as equal bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideglass.llm.bpe_codec import in_batches
from tideglass.llm.common import drop_written, fresh, key_filter, maybe_in, text_of, written

SIZE = 100
GRAM = 32
STEP = 8
#: Suffixes to a bucket, on average; segments of so many rows or fewer are sorted at once.
BUCKET_ROWS, _SMALL = 1 << 19, 1 << 12
_CHUNK = 1 << 17  # bytes that are hashed at once
_PLACE = 21  # bits of a place inside a chunk
_ITEM = "core long, context long, doc long, at long, span long"
_ITEM_PA = [*"core context doc at span".split()]


def _odd_inverse(b: int) -> int:
    x = b
    for _ in range(6):
        x = x * (2 - b * x) % (1 << 64)
    return x


class _Hash:
    """Polynomial hashes of all stretches of a chunk, modulo 2**64, from prefix sums."""

    def __init__(self, base: int, seed: int):
        self.table = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        n = _CHUNK + 4 * SIZE
        self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, b, np.uint64)]), dtype=np.uint64) for b in (base, _odd_inverse(base)))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[: len(data)], out=out[1:])
        return out

    def of(self, prefix: np.ndarray, start, end) -> np.ndarray:
        """Hashes of the bytes from start to end, well mixed."""
        x = (prefix[end] - prefix[start]) * self.down[start]
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


_hashes: list[_Hash] = []


def _both() -> list[_Hash]:
    if not _hashes:
        _hashes.extend([_Hash(0x9E3779B97F4A7C15, 1), _Hash(0xC2B2AE3D27D4EB4F, 2)])
    return _hashes


def _tag(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x94D049BB133111EB)


def anchored(data: np.ndarray, doc_end: np.ndarray, size: int = SIZE, gram: int = GRAM):
    """(core, context, anchor, first, last): the runs of strings that share an anchor; doc_end has each byte's document's end."""
    first, second = _both()
    n = len(data)
    if n < size:
        return None
    p1, p2 = first.prefix(data), second.prefix(data)
    g = first.of(p1, np.arange(n - gram + 1), np.arange(gram, n + 1))
    width, low = size - gram + 1, np.uint64((1 << _PLACE) - 1)
    # the least of each window of `width`: blocks' running minima from either side; of equal hashes the leftmost
    order = (g & ~low) | np.arange(len(g), dtype=np.uint64)
    grid = np.concatenate([order, np.full(-len(order) % width + width, ~np.uint64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - size + 1
    anchor = (np.minimum(behind[:count], ahead[width - 1 : width - 1 + count]) & low).astype(np.int64)
    inside = np.flatnonzero(np.arange(count) + size <= doc_end[:count])
    if not len(inside):
        return None
    anchor = anchor[inside]
    begins = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1] + 1)])
    s = np.flatnonzero(begins)
    a, lo, hi = anchor[s], inside[s], inside[np.append(s[1:], len(inside)) - 1]
    return g[a], second.of(p2, lo, hi + size) ^ _tag((a - lo) << 8 | (hi - lo)), a, lo, hi


def _items(core, context, doc, at, span) -> pa.RecordBatch:
    cols = [x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64) for x in (core, context, doc, at, span)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], _ITEM_PA)


def _raw(column) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a binary column without nulls, not copied."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _first_level(size: int, gram: int):
    """Items of all anchors: at is the place of the anchor, span says how far the first and last string start before it."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            data, ends = _raw(b.column(1))
            keys = b.column(0).to_numpy(zero_copy_only=False)
            total = int(ends[-1])
            # strings that start in [at, at + _CHUNK) need size - 1 bytes more
            for at in range(0, total, _CHUNK):
                stop = min(total, at + _CHUNK + size - 1)
                of = np.repeat(np.arange(len(keys)), np.clip(ends[1:], at, stop) - np.clip(ends[:-1], at, stop))
                made = anchored(data[at:stop], ends[of + 1] - at, size, gram)
                if made is not None:
                    core, context, a, lo, hi = made
                    d = of[lo]
                    yield _items(core, context, keys[d], a + at - ends[d], (a - lo) << 8 | (a - hi))

    return run


def _next_level(size: int, step: int):
    """Items of the undecided stretches of each document, cut into runs of `step` strings by distance to the anchor."""

    def run(batches):
        first, second = _both()
        for b in batches:
            data, ends = _raw(b.column(1))
            for k, (key, places) in enumerate(zip(b.column(0).to_pylist(), b.column(2), strict=True)):
                text = data[ends[k] : ends[k + 1]]
                packed = np.sort(places.values.to_numpy())
                a, far, near = packed >> 16, packed >> 8 & 255, packed & 255
                # one row for each run that a stretch touches
                runs = (far // step) - (near // step) + 1
                of = np.repeat(np.arange(len(a)), runs)
                run_no = (near // step)[of] + np.arange(len(of)) - np.repeat(np.cumsum(runs) - runs, runs)
                lo = a[of] - np.minimum(far[of], run_no * step + step - 1)
                hi = a[of] - np.maximum(near[of], run_no * step)
                core_lo = a[of] - run_no * step
                core_hi = core_lo - (step - 1) + size
                block = (lo // _CHUNK) if len(lo) else lo
                for c in np.unique(block):
                    own = block == c
                    base = max(0, int(c) * _CHUNK - size)
                    part = text[base : (int(c) + 1) * _CHUNK + 3 * size]
                    p1, p2 = first.prefix(part), second.prefix(part)
                    x = core_lo[own] - base, core_hi[own] - base, lo[own] - base, hi[own] - base + size
                    core = first.of(p1, x[0], x[1]) ^ _tag(run_no[own])
                    context = second.of(p2, x[2], x[3]) ^ _tag((a[of][own] - lo[own]) << 8 | (a[of][own] - hi[own]))
                    yield _items(core, context, np.full(int(own.sum()), key, np.int64), a[of][own], (a[of][own] - lo[own]) << 8 | (a[of][own] - hi[own]))

    return run


def multikey_order(tokens: list[np.ndarray], small: int = _SMALL) -> np.ndarray:
    """The order of rows by their tokens, of equal rows as they came, by multikey quicksort.

    A segment is parted about a pivot of its token: lesser and greater rows go on at the same token, equal ones at the
    next. Small segments are sorted at once by the tokens that are left.
    """
    by = np.arange(len(tokens[0]))
    segments = [(0, len(by), 0)]
    while segments:
        lo, hi, depth = segments.pop()
        if hi - lo < 2 or depth == len(tokens):
            continue
        rows = by[lo:hi]
        if hi - lo <= small:
            by[lo:hi] = rows[np.lexsort([t[rows] for t in reversed(tokens[depth:])])]
            continue
        x = tokens[depth][rows]
        pivot = np.sort(x[:: len(x) // 64 + 1])[len(x) // (len(x) // 64 + 1) // 2]
        less, more = x < pivot, x > pivot
        a, z = lo + np.count_nonzero(less), hi - np.count_nonzero(more)
        by[lo:hi] = np.concatenate([rows[less], rows[~(less | more)], rows[more]])
        segments += [(lo, a, depth), (a, z, depth + 1), (z, hi, depth)]
    return by


def _sort_bucket(batches):
    """Sorts a bucket and keeps what is repeated, undecided, or of the bucket's first and last core."""
    bucket = TaskContext.get().partitionId()
    parts = [*batches]
    cols = [np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in parts] or [np.zeros(0, np.int64)]) for k in range(5)]
    core, context, doc, at, span = cols
    if not len(core):
        return
    by = multikey_order([core, context, doc, at])
    core, context, doc, at, span = (c[by] for c in cols)
    new_core = np.concatenate([[True], core[1:] != core[:-1]])
    new = new_core | np.concatenate([[True], context[1:] != context[:-1]])
    cluster = np.cumsum(new_core) - 1
    many = np.bincount(cluster, new) > 1
    many, edge = many[cluster], (cluster == 0) | (cluster == cluster[-1])
    lead = np.zeros(len(core), bool)
    lead[0] = True
    keep = ~new | many | edge
    fields = [np.full(int(keep.sum()), bucket, np.int64), *(c[keep] for c in (core, context, doc, at, span)), ~new[keep], many[keep], lead[keep], edge[keep]]
    table = pa.RecordBatch.from_arrays([pa.array(f) for f in fields], ["bucket", *_ITEM_PA, "repeated", "many", "lead", "edge"])
    for k in range(0, table.num_rows, 1 << 17):
        yield table.slice(k, 1 << 17)


def _sorted_suffixes(items: DataFrame, label: str) -> DataFrame:
    """(doc, at, span, repeated): of items, the repeated and (repeated = false) the undecided ones."""
    kept = f"bucket long, {_ITEM}, repeated boolean, many boolean, lead boolean, edge boolean"
    # written first: sampling the splitters and dealing the rows would each run the Python code behind them
    items = written(items, f"{label}-items")
    buckets = items.count() // BUCKET_ROWS + 1
    t = written(items.repartitionByRange(buckets, "core", "context", "doc", "at").mapInArrow(_sort_bucket, kept), label)
    drop_written(items)
    # two rows a bucket at most
    edges = written(t.filter("edge").groupBy("bucket", "core").agg(F.min("context").alias("least"), F.max("context").alias("most")), f"{label}-edges")
    shared = edges.groupBy("core").agg((F.min("least") < F.max("most")).alias("shared")).filter("shared")
    ends = edges.groupBy("bucket").agg(F.min(F.struct("core", "least")).alias("head"), F.max(F.struct("core", "most")).alias("tail"))
    before = F.lag("tail").over(Window.orderBy("bucket"))
    goes_on = ends.withColumn("before", before).filter("before.core = head.core and before.most = head.least").select("bucket", F.lit(True).alias("goes_on"))
    # Spark broadcasts these only while they are small, as it knows from the table behind them
    found = t.join(goes_on, "bucket", "left").join(shared, "core", "left")
    repeated = F.col("repeated") | (F.col("lead") & F.coalesce("goes_on", F.lit(False)))
    undecided = F.col("many") | (F.col("edge") & F.coalesce("shared", F.lit(False)))
    return found.select("doc", "at", "span", repeated.alias("repeated"), undecided.alias("undecided")).filter("repeated or undecided").drop("undecided")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, doc_id, body): doc is a long that orders the rows; the id itself unless ids repeat or are null."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(docs, text_col).cast("binary").alias("body"))
    ids = rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null")
    if ids.isEmpty():
        return rows.select(F.col("doc_id").alias("doc"), "doc_id", "body")
    ordered = rows.repartitionByRange("doc_id", "body").sortWithinPartitions("doc_id", "body")
    return written(ordered.select(F.monotonically_increasing_id().alias("doc"), "doc_id", "body"), "keyed")


def _near(rows: DataFrame, chosen: DataFrame, there: bool = True) -> DataFrame:
    """The rows that may be among the chosen documents, or all others: only the former need to be shuffled to them."""
    key, *_ = fresh(rows, 1)
    bitmap = key_filter(chosen.select(F.xxhash64("doc").alias("hashed")), "hashed")
    return maybe_in(rows.withColumn(key, F.xxhash64("doc")), key, bitmap, there).drop(key)


def repeated_spans(rows: DataFrame, size: int = SIZE, gram: int = GRAM, step: int = STEP) -> DataFrame:
    """(doc, start, end): stretches of rows (doc, body) whose strings of `size` bytes all start earlier as well.

    doc tells which row comes first and is no null; bodies shorter than `size`, empty and null ones have no stretches,
    nor has an empty table. Other columns are not read.
    """
    rows, found = rows.select("doc", "body"), []
    items = rows.mapInArrow(_first_level(size, gram), _ITEM)
    for level, part in enumerate((step, 1, 0)):
        sorted_ = written(_sorted_suffixes(items, f"suffixes-{level}"), f"sorted-{level}")
        found.append(sorted_.filter("repeated"))
        if part:
            places = written(sorted_.filter("not repeated").groupBy("doc").agg(F.collect_list(F.shiftleft("at", 16).bitwiseOR(F.col("span"))).alias("places")), "places")
            items = _near(rows, places).join(places, "doc").select("doc", "body", "places").mapInArrow(_next_level(size, part), _ITEM)
    spans = found[0].unionByName(found[1]).unionByName(found[2])
    return spans.select("doc", F.expr("at - shiftright(span, 8)").alias("start"), F.expr(f"at - (span & 255) + {size}").alias("end"))


def remove_repeats(docs: DataFrame, size: int = SIZE, gram: int = GRAM, step: int = STEP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of docs: doc_id, n_bytes, spans (start, end), kept: what is removed from its UTF-8 bytes, and the rest.

    Each byte goes that a repeated string covers; spans are maximal. A null text counts as empty. Rows that repeat an id
    are documents of their own, ordered by their bytes; null ids come before others. Other columns are not read. An empty
    table gives an empty result.
    """
    rows = _keyed(docs, id_col, text_col)
    spans = written(repeated_spans(rows, size, gram, step).groupBy("doc").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")), "spans")

    def run(batches):
        def made():
            for b in batches:
                for doc, body, starts, ends in zip(b.column(0).to_pylist(), b.column(1), b.column(2), b.column(3), strict=True):
                    raw = body.as_py()
                    if not starts.is_valid:
                        yield len(raw), (doc, len(raw), [], raw)
                        continue
                    s, e = starts.values.to_numpy(), ends.values.to_numpy()
                    by = np.argsort(s, kind="stable")
                    s, e = s[by], np.maximum.accumulate(e[by])
                    cut = np.flatnonzero(np.concatenate([[True], s[1:] > e[:-1]]))
                    s, e = s[cut], e[np.append(cut[1:], len(e)) - 1]
                    view = memoryview(raw)
                    rest = b"".join(view[a:z] for a, z in zip([0, *e.tolist()], [*s.tolist(), len(raw)], strict=True))
                    yield len(rest) + 16 * len(s), (doc, len(raw), [{"start": a, "end": z} for a, z in zip(s.tolist(), e.tolist(), strict=True)], rest)

        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield from in_batches(made(), {"doc_id": pa.int64(), "n_bytes": pa.int64(), "spans": kind, "kept": pa.binary()})

    none = F.lit(None).cast("array<bigint>")
    whole = _near(rows, spans, there=False).select("doc_id", "body", none.alias("starts"), none.alias("ends"))
    joined = whole.unionByName(_near(rows, spans).join(spans, "doc", "left").select("doc_id", "body", "starts", "ends"))
    return joined.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def repeat_digests(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Null and empty texts have no bytes; other columns are not read; nulls and repeats among ids are treated as
    remove_repeats says. An empty table gives an empty result.
    """
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
