"""Text sources: physical lines with their numbers, headed and commented CSV, API pages, manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def numbered(lines: DataFrame, source: str = "source", block: str = "block_start", order: str = "order_in_block") -> DataFrame:
    """lines with line_number, from 1 within each source.

    Rows are counted by block of the file; sums over the blocks before give each block its first number, and a row's
    place in its block does the rest. No file is sorted in one task.
    """
    counts = lines.groupBy(source, block).agg(F.count("*").alias("n"))
    before = Window.partitionBy(source).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(source, block, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy(source, block).orderBy(order))
    return lines.withColumn("_place", place).join(first, [source, block]).withColumn("line_number", F.col("first") + F.col("_place")).drop("first", "_place")


def read_lines(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """(source, line_number, raw): the physical lines of text files; line ends are cut off, blank lines count.

    No match is an error of Spark's reader.
    """
    reader = spark.read.option("lineSep", "\n")
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    text = reader.text(paths).select(
        F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("block_start"), F.monotonically_increasing_id().alias("order_in_block"), F.regexp_replace("value", "\r+$", "").alias("raw")
    )
    return numbered(text).select("source", "line_number", "raw")


def lines_of(texts: DataFrame, source: str, text: str) -> DataFrame:
    """(source, line_number, raw): the lines of a text column; the empty line behind a last line end is none."""
    cut = texts.select(F.col(source).cast("string").alias("source"), F.posexplode(F.split(F.regexp_replace(F.nullif(F.col(text), F.lit("")), r"\n\z", ""), "\n")).alias("at", "raw"))
    return cut.select("source", (F.col("at") + 1).cast("long").alias("line_number"), F.regexp_replace("raw", "\r+$", "").alias("raw"))


def _with_cells(lines: DataFrame, width: int) -> DataFrame:
    """lines with the cells of their CSV in raw. A line is parsed once: the optimizer would parse it for each cell that is named."""
    schema = ", ".join(f"c{k} string" for k in range(width))
    parsed = F.from_csv("raw", schema, {"emptyValue": "", "nullValue": "\u0000", "mode": "PERMISSIVE"})
    names = [f"_c{k}" for k in range(width)]
    return lines.select("*", F.inline(F.array(parsed)).alias(*names)).withColumn("cells", F.array(*names)).drop(*names)


def headed_csv(lines: DataFrame, header_cell: str, width: int) -> DataFrame:
    """(source, line_number, header, cells): what follows the first line of each source that has the header cell."""
    cells = _with_cells(lines.filter(F.trim("raw") != ""), width)
    heads = cells.filter(F.array_contains(F.transform("cells", lambda c: F.trim(c)), header_cell)).groupBy("source").agg(F.min(F.struct("line_number", "cells")).alias("h"))
    below = cells.join(heads, "source").filter(F.col("line_number") > F.col("h.line_number"))
    return below.select("source", "line_number", F.transform("h.cells", lambda c: F.trim(c)).alias("header"), "cells")


def named_cells(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """rows of headed_csv with a column for each wanted header cell; one that a header lacks ends the job."""
    at = lambda name: F.array_position("header", name)
    take = lambda name: F.when(at(name) > 0, F.get("cells", (at(name) - 1).cast("int"))).otherwise(F.raise_error(F.lit(f"no column {name}")).cast("string"))
    return rows.select("source", "line_number", *(take(n).alias(n) for n in names))


def commented_csv(lines: DataFrame, header: Sequence[str], required: Sequence[str], width: int) -> DataFrame:
    """(source, line_number, metadata, cells): CSV below a preamble of '# key: value' lines and an exact header.

    A source without one of the required keys, or without the header as its first other line, ends the job. Rows whose
    cells are all blank are left out; cells behind the header's last column stay in the array.
    """
    mark = lines.filter(F.trim("raw") != "").withColumn("comment", F.col("raw").startswith("#"))
    pair = F.regexp_extract("raw", r"^#\s*([^:]+):\s*(.*)$", 1), F.regexp_extract("raw", r"^#\s*([^:]+):\s*(.*)$", 2)
    first = F.min(F.when(~F.col("comment"), F.struct("line_number", "raw")))
    entries = F.collect_list(F.when(F.col("comment") & (pair[0] != ""), F.struct(F.trim(pair[0]).alias("k"), F.trim(pair[1]).alias("v"))))
    heads = mark.groupBy("source").agg(first.alias("h"), F.map_from_entries(entries).alias("metadata"))
    wanted = ",".join(header)
    fine = (F.regexp_replace("h.raw", r"\s*,\s*", ",") == wanted) & F.forall(F.array(*map(F.lit, required)), lambda k: F.col("metadata")[k].isNotNull())
    heads = heads.select("source", F.when(fine, F.col("h.line_number")).otherwise(F.raise_error(F.concat(F.lit("preamble or header not as declared: "), F.col("source"))).cast("long")).alias("at"), "metadata")
    below = mark.filter(~F.col("comment")).join(heads, "source").filter(F.col("line_number") > F.col("at"))
    cells = _with_cells(below, width).select("source", "line_number", "metadata", F.filter("cells", lambda c: c.isNotNull()).alias("cells"))
    return cells.filter(F.exists("cells", lambda c: F.trim(c) != ""))


def api_pages(pages: DataFrame, columns: Sequence[str], source: str = "source", body: str = "body") -> DataFrame:
    """(source, row_number, each column): the rows of CSV pages that end their lines with CR LF and bear the exact header."""
    text = F.col(body)
    whole = F.when(text.endswith("\r\n"), text).otherwise(F.raise_error(F.concat(F.lit("page without a final line end: "), F.col(source))).cast("string"))
    lines = F.split(F.regexp_replace(whole, "\r\n$", ""), "\r\n")
    cut = pages.select(F.col(source).alias("source"), F.explode(F.array(lines)).alias("lines"))
    head = F.when(F.get("lines", F.lit(0)) == ",".join(columns), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("header not as declared: "), F.col("source"))).cast("boolean"))
    rows = cut.filter(head).select("source", F.posexplode("lines").alias("row_number", "raw")).filter("row_number > 0")
    schema = ", ".join(f"`{c}` string" for c in columns)
    # a row is parsed once: the optimizer would parse it for each column that is named
    return rows.select("source", "row_number", F.inline(F.array(F.from_csv("raw", schema, {"emptyValue": "", "nullValue": "\u0000", "mode": "FAILFAST"}))).alias(*columns))


def hits_count(body: Column) -> Column:
    """The published number of matches in a count response; anything else than a plain count ends the job."""
    kind, n = F.get_json_object(body, "$.type"), F.get_json_object(body, "$.numberMatched")
    empty = F.get_json_object(body, "$.features") == "[]"
    fine = (kind == "FeatureCollection") & empty & n.rlike(r"^\d{1,18}$")
    return F.when(F.coalesce(fine, F.lit(False)), n.cast("long")).otherwise(F.raise_error(F.lit("no valid count response")).cast("long"))


def read_manifest(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A tab-separated manifest with exactly these columns, all as text."""
    found = spark.read.csv(path, sep="\t", header=True, inferSchema=False, emptyValue="", nullValue="\u0000")
    if list(found.columns) != list(columns):
        raise ValueError(f"manifest columns are {found.columns}, not {list(columns)}")
    return found


def check_members(members: DataFrame, file_col: str, pattern: str) -> DataFrame:
    """Members whose file names fit the pattern and occur once; others end the job with up to three examples."""
    bad = members.filter(~F.coalesce(F.col(file_col).rlike(pattern), F.lit(False))).select(file_col).limit(3).collect()
    twice = members.groupBy(file_col).count().filter("count > 1").select(file_col).limit(3).collect()
    if bad or twice:
        raise ValueError(f"manifest names {[r[0] for r in bad]} are not as declared or {[r[0] for r in twice]} repeat")
    return members


def read_wide_csv(spark: SparkSession, path: str, columns: Sequence[str], na_values: Sequence[str] = ()) -> DataFrame:
    """A CSV table as text columns: ids stay text, and the usual marks and the given ones count as null."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    found = spark.read.csv(path, header=True, schema=schema, enforceSchema=False, emptyValue="", nullValue="\u0000")
    missing = ["", "NA", "N/A", "NaN", "nan", "null", "NULL", *na_values]
    return found.select(*(F.when(~F.col(c).isin(missing), F.col(c)).alias(c) for c in columns))


def read_wide_parquet(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], entity: str) -> DataFrame:
    """The wanted columns of Parquet files; a missing one, or an entity column that isn't text, is refused before any row is read."""
    return require_columns(spark.read.parquet(*([paths] if isinstance(paths, str) else paths)), columns, [entity]).select(*columns)


def require_columns(df: DataFrame, columns: Sequence[str], text: Sequence[str] = ()) -> DataFrame:
    """df, if it has these columns and the `text` ones are strings."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    if wrong := [c for c in text if dict(df.dtypes)[c] != "string"]:
        raise ValueError(f"ids must be text: {', '.join(wrong)}")
    return df


def month_matrix(table: DataFrame, station: str, year: str, month: str, value_stem: str, flag_stem: str) -> DataFrame:
    """(station, year, month, day, value, flag): a row for each of the 31 day slots of a station's months."""
    require_columns(table, [station, year, month, *(f"{s}{d}" for d in range(1, 32) for s in (value_stem, flag_stem))])
    values, flags = (F.array(*(F.col(f"{stem}{d}").cast(kind) for d in range(1, 32))) for stem, kind in ((value_stem, "double"), (flag_stem, "string")))
    # two plain arrays and a generator: code that makes a struct of each slot is too long to be compiled
    both = table.select(F.col(station).alias("station"), F.col(year).cast("int").alias("year"), F.col(month).cast("int").alias("month"), values.alias("values"), flags.alias("flags"))
    slots = both.select("*", F.posexplode("values").alias("at", "value"))
    return slots.select("station", "year", "month", (F.col("at") + 1).alias("day"), "value", F.coalesce(F.get("flags", F.col("at")), F.lit("")).alias("flag"))
