"""Jobs over a list of files: what a manifest says of them is proven, then all of them are read as one table.

Files come as rows of (path, content), as Spark's binaryFile source reads them. Compressed ones are decoded in bounded
pieces inside the tasks; what else is asked of a file (its station, its digest) is a join on its name.
"""

from __future__ import annotations

import lzma
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.functions.scalars import raw_digest
from tideglass.operators.gates import GateError, first_reason
from tideglass.plans.tables import parse_unit_values, select_members, selection_fingerprint
from tideglass.session import kept
from tideglass.sources.lines import check_members, commented_csv

#: Bytes that a decoder is given and may give back at once, and bytes of lines that a task hands on at once.
_PIECE, _OUT = 1 << 20, 4 << 20


def read_files(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """(path, file_name, content) of files; no match is an error of Spark's reader."""
    reader = spark.read.format("binaryFile")
    found = (reader.option("pathGlobFilter", glob) if glob else reader).load(paths)
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "content")


def file_digests(files: DataFrame) -> DataFrame:
    """(file_name, size_bytes, sha256) of (file_name, content)."""
    return files.select("file_name", F.octet_length("content").cast("long").alias("size_bytes"), raw_digest(F.col("content")).alias("sha256"))


def check_listed(manifest: DataFrame, digests: DataFrame) -> DataFrame:
    """The rows of a manifest (file_name, size_bytes, sha256, ...) with their first fault, null where the file is as listed.

    Faults: unsafe_name (a path, a hidden or an empty name), repeated_name, bad_digest (not 64 hexadecimal digits),
    missing_file, size_differs, digest_differs. Files that nobody lists play no part.
    """
    names = manifest.groupBy("file_name").agg(F.count("*").alias("_times")).withColumnRenamed("file_name", "_name")
    there = digests.select(F.col("file_name").alias("_file"), F.col("size_bytes").alias("_size"), F.col("sha256").alias("_sha256"), F.lit(True).alias("_there"))
    own = manifest.join(names, F.col("file_name").eqNullSafe(F.col("_name"))).join(there, F.col("file_name") == F.col("_file"), "left")
    fault = first_reason(
        ("unsafe_name", ~safe_name(F.col("file_name"))), ("repeated_name", F.col("_times") > 1), ("bad_digest", ~F.col("sha256").rlike("^[0-9a-f]{64}$")), ("missing_file", F.col("_there").isNull()),
        ("size_differs", F.col("size_bytes").cast("long") != F.col("_size")), ("digest_differs", F.col("sha256") != F.col("_sha256")),
    )
    return own.withColumn("fault", fault).select(*manifest.columns, "fault")


def safe_name(name: Column) -> Column:
    """Whether a name is that of a file in its own folder."""
    return F.coalesce(name.rlike(r"^[A-Za-z0-9_][A-Za-z0-9._-]*$"), F.lit(False))


def _decoded(name: str, content: bytes) -> Iterator[bytes]:
    """The bytes of a file by its suffix (.xz, .gz, else as they are), in pieces of bounded size; several streams in a row count."""
    view = memoryview(content)
    if name.endswith(".xz"):
        decoder, at = lzma.LZMADecompressor(lzma.FORMAT_XZ), 0
        while True:
            given = view[at : at + _PIECE] if decoder.needs_input else b""
            at += len(given)
            if decoder.needs_input and not given:
                raise ValueError(f"{name} ends within a stream")
            yield decoder.decompress(given, _PIECE)
            if decoder.eof:
                at -= len(decoder.unused_data)
                if not bytes(view[at:]).strip(b"\0"):
                    return
                decoder = lzma.LZMADecompressor(lzma.FORMAT_XZ)
    elif name.endswith(".gz"):
        decoder, at, left = zlib.decompressobj(31), 0, b""
        while True:
            given = left or view[at : at + _PIECE]
            at += 0 if left else len(given)
            if not given:
                raise ValueError(f"{name} ends within a stream")
            yield decoder.decompress(given, _PIECE)
            left = decoder.unconsumed_tail
            if decoder.eof:
                at -= len(decoder.unused_data)
                if at == len(view):
                    return
                decoder, left = zlib.decompressobj(31), b""
    else:
        for k in range(0, len(view), _PIECE):
            yield bytes(view[k : k + _PIECE])


def _lines(name: str, content: bytes) -> Iterator[bytes]:
    """Lines without their ends; an empty line behind the last line end is none."""
    rest = []
    for piece in _decoded(name, content):
        first, *more = piece.split(b"\n")
        rest.append(first)
        for line in more:
            yield b"".join(rest).rstrip(b"\r")
            rest = [line]
    if last := b"".join(rest):
        yield last.rstrip(b"\r")


def member_lines(files: DataFrame) -> DataFrame:
    """(source, line_number, raw): the lines of (file_name, content), numbered from 1; text that isn't UTF-8 ends the job."""

    def run(batches):
        types = {"source": pa.string(), "line_number": pa.int64(), "raw": pa.string()}
        cols, size = ([], [], []), 0  # small files share a batch
        make = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types.values(), strict=True)], names=[*types])
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for n, raw in enumerate(_lines(name, content.as_py() or b""), 1):
                    for c, v in zip(cols, (name, n, raw.decode("utf-8")), strict=True):
                        c.append(v)
                    size += len(name) + len(raw) + 16
                    if size >= _OUT:
                        yield make()
                        cols, size = ([], [], []), 0
        yield make()

    return files.select("file_name", "content").mapInArrow(run, "source string, line_number long, raw string")


@dataclass(frozen=True)
class MemberValues:
    """accepted: values with the file and line they came from; inputs: a row a file that was read; counts: members by class
    (one row); fingerprint: one row with the digest of the selection."""

    accepted: DataFrame
    inputs: DataFrame
    counts: DataFrame
    fingerprint: DataFrame


def corrected_values(files: DataFrame, manifest: DataFrame, pattern: str, header: Sequence[str], required: Sequence[str] = ("Station", "Unit"), areas: DataFrame | None = None, limit: float | None = None, width: int = 16, qualifier_at: int = 5) -> MemberValues:
    """Corrected unit values of all members of a manifest (file_name, size_bytes, sha256) in one job.

    pattern: a regular expression for whole file names, with the station and the first day as its groups. Every listed
    file has to be there with the listed size and digest; files that nobody lists are left alone. With areas (station,
    area) only members of stations up to the limit are read. The station of a file's name has to be the one that its
    preamble names. Each value carries its file, line and the file's digest.
    """
    named = check_members(manifest, "file_name", pattern)
    digests = kept(file_digests(files), "digests")
    checked = check_listed(named, digests)
    if bad := checked.filter("fault IS NOT NULL").select("file_name", "fault").orderBy("file_name").limit(3).collect():
        raise GateError(f"files are not as listed: {[tuple(r) for r in bad]}")
    members = named.select("file_name", F.regexp_extract("file_name", pattern, 1).alias("station"), F.regexp_extract("file_name", pattern, 2).alias("first_day"), F.col("sha256").alias("file_sha256"), F.col("size_bytes").cast("long"))
    none = members.select(F.col("station"), F.lit(None).cast("double").alias("area")).limit(0)
    chosen, counts = select_members(members, none if areas is None else areas, "station", limit)
    chosen = kept(chosen, "chosen")
    # written, or the files would be decoded again for the rows behind their preambles
    lines = kept(member_lines(files.join(chosen.select("file_name"), "file_name", "left_semi")), "lines")
    rows = commented_csv(lines, header, required, width)
    own = rows.join(chosen.select(F.col("file_name").alias("source"), "station", "first_day", "file_sha256"), "source")
    same = F.when(F.col("metadata")["Station"] == F.col("station"), F.col("station")).otherwise(F.raise_error(F.concat(F.lit("another station than in the name of "), F.col("source"))).cast("string"))
    values = parse_unit_values(own.withColumn("station", same), F.col("station"), qualifier_at, ("source", "line_number", "file_sha256"))
    inputs = chosen.select(F.concat(F.lit("member:"), "file_name").alias("input_key"), "file_name", "station", "first_day", "size_bytes", F.col("file_sha256").alias("sha256"), F.lit("observation_source").alias("input_role"))
    return MemberValues(values.withColumnRenamed("source", "file_name"), inputs, counts, selection_fingerprint(chosen, ["file_name", "file_sha256"], {"limit": limit}))
