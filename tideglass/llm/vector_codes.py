"""Codes of vectors: each part of a vector becomes the index of its nearest entry in that part's codebook.

An entry can be nearest only if it lies, in every dimension, no farther off than some entry known to be near. The entries'
coordinates are sorted for each dimension, with a mask of the entries up to each place; what lies within the radius is a
range of places, so the difference of two prefix masks, and the AND of the dimensions' masks holds every candidate. The
candidates' whole distances are compared, so the codes are exact. Codebooks are refined by sums of whole tables, made in
the tasks; the driver sees a row for each entry and dimension.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideglass.llm.common import written

#: Rows whose parts are compared at once; integer components beyond this end the job, as sums of squares would not fit longs.
_ROWS, MOST = 1 << 14, 1 << 26


class Codebook:
    """The entries of one part's codebook, sorted in each dimension for search by ranges."""

    def __init__(self, entries: np.ndarray):
        if not 0 < len(entries) <= 64:
            raise ValueError("a codebook has 1 to 64 entries, one for each bit of a mask")
        self.entries = entries = np.asarray(entries, np.int64)
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, order, 0)
        bits = np.uint64(1) << order.astype(np.uint64)
        self.upto = np.concatenate([np.zeros((1, entries.shape[1]), np.uint64), np.bitwise_or.accumulate(bits, axis=0)])
        spread = self.sorted[-1] - self.sorted[0]
        self.widest = int(spread.argmax())
        self.order = order[:, self.widest]

    def candidates(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries within the radius of each row of x in every dimension."""
        masks = np.full(len(x), ~np.uint64(0))
        for j in range(x.shape[1]):
            column = self.sorted[:, j]
            low, high = np.searchsorted(column, x[:, j] - radius, "left"), np.searchsorted(column, x[:, j] + radius, "right")
            masks &= self.upto[high, j] & ~self.upto[low, j]
        return masks

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the nearest entry, squared distance) of each row of x; ties go to the lower index."""
        middle = (self.sorted[1:, self.widest] + self.sorted[:-1, self.widest]) / 2
        start = self.entries[self.order[np.searchsorted(middle, x[:, self.widest])]]
        radius = np.sqrt(((x - start) ** 2).sum(axis=1).astype(np.float64)).astype(np.int64) + 1  # never below the true distance
        masks = self.candidates(x, radius)
        code, best = np.zeros(len(x), np.int64), np.full(len(x), np.iinfo(np.int64).max)
        for e in range(len(self.entries)):
            own = np.flatnonzero(masks >> np.uint64(e) & np.uint64(1))
            d = ((x[own] - self.entries[e]) ** 2).sum(axis=1)
            nearer = d < best[own]
            code[own[nearer]], best[own[nearer]] = e, d[nearer]
        return code, best


def integer_vectors(df: DataFrame, vector_col: str, scale: int = 4096) -> DataFrame:
    """df with floor(scale * x) of each component, as 32-bit little-endian integers in one binary, in place of its vectors.

    Rows whose vector is null or empty, or holds null or non-finite components, are left out; other columns stay.
    """
    rest = [c for c in df.columns if c != vector_col]
    schema = df.select(*rest).schema.add(vector_col, "binary")

    def run(batches):
        for b in batches:
            vectors = b.column(len(rest))
            ends, flat = vectors.offsets.to_numpy().astype(np.int64), vectors.values
            x = flat.to_numpy(zero_copy_only=False).astype(np.float64)
            fine = np.isfinite(x)  # nulls have become NaN
            faults = np.concatenate([[0], np.cumsum(~fine)])[ends]
            keep = np.flatnonzero((np.diff(faults) == 0) & (np.diff(ends) > 0) & vectors.is_valid().to_numpy(zero_copy_only=False))
            whole = np.floor(scale * np.where(fine, x, 0))
            if (np.abs(whole) > MOST).any():
                raise ValueError(f"a component times {scale} lies beyond {MOST}")
            raw = whole.astype("<i4").tobytes()
            made = pa.array([raw[4 * ends[k] : 4 * ends[k + 1]] for k in keep.tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(keep)) for c in b.columns[: len(rest)]), made], names=b.schema.names)

    return df.select(*rest, F.col(vector_col).cast("array<double>").alias(vector_col)).mapInArrow(run, schema)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, width).astype(np.int64)


def _chunks(batches, at: int, width: int):
    for b in batches:
        for k in range(0, b.num_rows, _ROWS):
            part = b.slice(k, _ROWS)
            yield part, _matrix(part.column(at), width)


def first_entries(vectors: DataFrame, id_col: str, vec: str, parts: int, entries: int) -> np.ndarray:
    """[part, entry, position]: the parts of the vectors of the least ids; nulls come last, equal ids in the order of their bytes."""
    rows = vectors.select(id_col, vec).orderBy(F.col(id_col).asc_nulls_last(), vec).limit(entries).collect()
    found = [np.frombuffer(r[1], "<i4").astype(np.int64) for r in rows]
    if found and (len({len(v) for v in found}) > 1 or len(found[0]) % parts):
        raise ValueError(f"vectors have to be of one length that {parts} divides")
    return np.array(found).reshape(len(found), parts, -1).transpose(1, 0, 2) if found else np.zeros((parts, 0, 0), np.int64)


def refine(vectors: DataFrame, vec: str, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each entry becomes floor(sum / count) of the parts nearest to it, unused ones stay."""
    parts, entries, width = books.shape

    def run(batches):
        own = [Codebook(b) for b in books]
        sums, counts = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for _, x in _chunks(batches, 0, parts * width):
            for p in range(parts):
                piece = x[:, p * width : (p + 1) * width]
                code = own[p].nearest(piece)[0]
                for e in np.unique(code):
                    chosen = piece[code == e]
                    sums[p, e] += chosen.sum(axis=0)
                    counts[p, e] += len(chosen)
        slots = np.concatenate([sums, counts[..., None]], axis=2).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(slots)), pa.int32()), pa.array(slots, pa.int64())], ["slot", "total"])

    rows = vectors.select(vec).mapInArrow(run, "slot int, total long").groupBy("slot").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()  # a row an entry and dimension
    new, total = books.copy(), {r["slot"]: int(r["total"]) for r in rows}
    for p in range(parts):
        for e in range(entries):
            at = (p * entries + e) * (width + 1)
            if n := total.get(at + width, 0):
                new[p, e] = [total[at + j] // n for j in range(width)]
    return new


def fit_codebooks(vectors: DataFrame, id_col: str, vec: str, parts: int = 8, entries: int = 16, rounds: int = 6) -> np.ndarray:
    """[part, entry, position] codebooks after so many rounds over all vectors; fewer vectors than entries give fewer entries."""
    books = first_entries(vectors, id_col, vec, parts, entries)
    for _ in range(rounds if books.size else 0):
        books = refine(vectors, vec, books)
    return books


def encode_vectors(vectors: DataFrame, vec: str, books: np.ndarray) -> DataFrame:
    """vectors with code (binary, a byte for each part) and error (squared distances summed over parts) in place of vec.

    Columns of these two names are replaced, all others stay. A vector of another length than the codebooks' ends the job.
    """
    parts, _, width = books.shape
    rest = [c for c in vectors.columns if c not in (vec, "code", "error")]
    schema = vectors.select(*rest).schema.add("code", "binary").add("error", "long")

    def run(batches):
        own = [Codebook(b) for b in books]
        for b, x in _chunks(batches, len(rest), parts * width):
            found = [own[p].nearest(x[:, p * width : (p + 1) * width]) for p in range(parts)]
            codes = np.stack([c for c, _ in found], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(rest)], pa.array([r.tobytes() for r in codes], pa.binary()), pa.array(sum(d for _, d in found), pa.int64())], names=[*b.schema.names[: len(rest)], "code", "error"])

    if not books.size:
        return vectors.select(*rest, F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")).limit(0)
    return vectors.select(*rest, vec).filter(F.when(F.octet_length(vec) == 4 * parts * width, True).otherwise(F.raise_error(F.lit("a vector of another length")).cast("boolean"))).mapInArrow(run, schema)


def decode_vectors(codes: DataFrame, books: np.ndarray, scale: int = 4096) -> DataFrame:
    """codes with vector (array of doubles): the entries that a code names, scaled back. Null codes give null vectors."""
    table = [F.array(*(F.array(*(F.lit(float(x) / scale) for x in entry)) for entry in part)) for part in books]
    at = lambda p: F.conv(F.hex(F.substring("code", p + 1, 1)), 16, 10).cast("int")
    return codes.withColumn("vector", F.when(F.col("code").isNotNull(), F.concat(*(F.get(t, at(p)) for p, t in enumerate(table)))))


def code_table(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6) -> DataFrame:
    """Per kept row: vec_id, code, error, label_error, codebooks_sha256.

    Rows without a whole finite vector are left out. Rows of a null id come last among those that make the first
    codebooks; repeated ids are rows like any other; null labels count together. An empty table gives no rows.
    """
    source = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    vectors = written(integer_vectors(source, "vector"), "vectors")
    books = fit_codebooks(vectors, "vec_id", "vector", parts, entries, rounds)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = written(encode_vectors(vectors, "vector", books), "codes")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    both = coded.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return both.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def code_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The same in SQL: each round compares every part with every entry of its codebook."""
    near = lambda book: f"""SELECT k, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (SELECT x.k, x.p, c.e, list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM x JOIN {book} c USING (p)) GROUP BY k, p"""
    steps = []
    for r in range(rounds):
        steps.append(f"a{r} AS MATERIALIZED ({near(f'b{r}')})")
        steps.append(f"""u{r} AS (SELECT p, e, i, sum(v[i])::HUGEINT AS s, count(*)::HUGEINT AS n FROM x JOIN a{r} USING (k, p), range(1, (SELECT max(len(v)) + 1 FROM x)) t(i) GROUP BY p, e, i)""")
        steps.append(f"""w{r} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM u{r} GROUP BY p, e)""")
        steps.append(f"b{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(w{r}.v, b{r}.v) AS v FROM b{r} LEFT JOIN w{r} USING (p, e))")
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id) AS k, vec_id, label, list_transform(embedding, lambda c: CAST(floor({scale} * c::DOUBLE) AS BIGINT)) AS v FROM embeddings
            WHERE len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)
        ), x AS MATERIALIZED (SELECT k, p, list_slice(v, p * (len(v) // {parts}) + 1, (p + 1) * (len(v) // {parts})) AS v FROM kept, range({parts}) t(p)),
        b0 AS (SELECT p, k - 1 AS e, v FROM x WHERE k <= {entries}), {', '.join(steps)},
        z AS (SELECT k, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM ({near(f'b{rounds}')}) GROUP BY k),
        digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM z JOIN kept USING (k), digest
    """
