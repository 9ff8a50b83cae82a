"""What the operators of this subpackage share: the shared folder, written tables, hash filters."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of a hash filter for each key, and the most of all: 64 MB, whatever the data's size.
BITS_A_KEY, FILTER_BITS = 16, 29
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PART_BITS = 15  # of one part, as bitmap_construct_agg makes them


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; unset, a new one, under a local master only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """The rows of df, written once to the shared folder and read from there: survives lost executors."""
    spark = df.sparkSession
    path, before = new_path(spark, label), spark.conf.get(_CLEAN)
    spark.conf.set(_CLEAN, "true")  # the shuffle files behind a written table have no further use
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Removes the files behind a table of written() that no later step reads."""
    for name in {f.rpartition("/")[0] for f in df.inputFiles()[:1]}:
        at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(name)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, _UPPER, _LOWER)


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """df, after limiting the session's Arrow batches to so many rows: whole texts are long, and workers hold a batch."""
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
    return df


def release_memory() -> None:
    """Gives memory that a task has freed back to the system: Arrow's, and, where there is glibc, that of all else."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):
        trim(0)


def released(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """batches; behind the last one memory is released: workers live on, and others share the executor's memory."""
    yield from batches
    release_memory()


def text_of(df: DataFrame, text_col: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def filter_bits(keys: int) -> int:
    """Bits of a slot's number in a filter of so many keys."""
    return min(FILTER_BITS, max(_PART_BITS, (BITS_A_KEY * keys).bit_length()))


def key_filter(keys: DataFrame, key: str) -> DataFrame:
    """A bitmap of the hashes of one long column, written: at most 2**FILTER_BITS bits in 4 KB parts."""
    bits = filter_bits(keys.count())
    slot = F.col(key).bitwiseAND(F.lit((1 << bits) - 1))
    made = keys.select(
        F.shiftright(slot, _PART_BITS).alias("_part"), slot.bitwiseAND(F.lit((1 << _PART_BITS) - 1)).alias("_bit")
    ).groupBy("_part").agg(F.bitmap_construct_agg("_bit").alias("_bits"), F.lit(bits).alias("_size"))
    return written(made, "filter")


def fresh(df: DataFrame, count: int) -> list[str]:
    """Column names that df doesn't have."""
    stem, taken = "_x", {c.lower() for c in df.columns}
    while any(f"{stem}{k}" in taken for k in range(count)):
        stem += "x"
    return [f"{stem}{k}" for k in range(count)]


def maybe_in(df: DataFrame, key: str, bitmap: DataFrame, there: bool = True) -> DataFrame:
    """The rows of df whose key may be in the filter (none that is in it is missing), or all others.

    The filter is broadcast: FILTER_BITS bounds its size. When it is full it passes every row, and the joins that follow
    are still right.
    """
    size = (bitmap.select("_size").first() or [_PART_BITS])[0]
    slot = F.col(key).bitwiseAND(F.lit((1 << size) - 1))
    part, bit, bits = fresh(df, 3)
    own = df.withColumns({part: F.shiftright(slot, _PART_BITS), bit: slot.bitwiseAND(F.lit((1 << _PART_BITS) - 1))})
    joined = own.join(F.broadcast(bitmap.select(F.col("_part").alias(part), F.col("_bits").alias(bits))), part, "inner" if there else "left")
    held = F.expr(f"shiftright(cast(conv(hex(substring({bits}, cast(shiftright({bit}, 3) as int) + 1, 1)), 16, 10) as int), cast({bit} & 7 as int)) & 1")
    return joined.filter(F.coalesce(held, F.lit(0)) == int(there)).select(*df.columns)


def without(docs: DataFrame, dropped: DataFrame, keys: list[Column]) -> DataFrame:
    """docs without the rows whose keys, in order, are a row of `dropped`; keys with nulls match nothing.

    Only rows whose first key a filter passes go through the join; all others stay where they are. The join is a left
    one with a mark: an anti join would be pushed below the filter, and all rows would be shuffled.
    """
    first, mark, *names = fresh(docs, len(keys) + 2)
    gone = written(dropped.toDF(*names).distinct(), "dropped")
    bitmap = key_filter(gone.select(F.xxhash64(names[0]).alias("hashed")).distinct(), "hashed")
    keyed = docs.withColumn(first, F.xxhash64(keys[0]))
    stay = maybe_in(keyed, first, bitmap, there=False)
    near = maybe_in(keyed, first, bitmap).withColumns(dict(zip(names, keys, strict=True)))
    rest = near.join(gone.withColumn(mark, F.lit(True)), names, "left").filter(F.col(mark).isNull())
    return stay.select(*docs.columns).unionByName(rest.select(*docs.columns))


def in_order(df: DataFrame, order: list[Column], place: str = "place") -> DataFrame:
    """df with the number of each row, from 1, in the given order; equal rows are numbered in whatever order they stand.

    Ranges of sampled splitters are sorted apart, and numbered from the rows of the ranges before: one shuffle, no task
    with all rows. df has to be read from a written table: splitters are sampled from it first, and rows that tie are
    dealt to several ranges by where they stand in it.
    """
    spark = df.sparkSession
    at, part, base, tied = fresh(df, 4)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order, F.col(tied)]
    dealt = df.withColumn(tied, F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    kept = written(dealt.withColumn(at, F.monotonically_increasing_id()), "ordered")
    split = kept.withColumns({part: F.shiftright(at, 33), at: F.col(at).bitwiseAND(F.lit((1 << 33) - 1))})
    counts, rows, before = split.groupBy(part).agg(F.max(at)).orderBy(part).collect(), [], 0  # a row a range
    for r in counts:
        rows.append((r[0], before))
        before += r[1] + 1
    bases = spark.createDataFrame(rows, f"{part} long, {base} long")
    return split.join(F.broadcast(bases), part).withColumn(place, F.col(base) + F.col(at) + 1).select(*df.columns, place)
