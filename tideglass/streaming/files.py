"""Parsing files as they arrive: each file once, from where the last call stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.sources.lines import lines_of


def ingest_new_files(spark: SparkSession, folder: str, checkpoint: str, handle: Callable[[DataFrame, int], None], glob: str | None = None) -> None:
    """Passes the lines (source, line_number, raw) of all files that the checkpoint doesn't know yet to handle(lines, batch).

    A batch that failed comes again with the same files; handle() must write what it makes under the batch's number.
    """
    reader = spark.readStream.format("text").option("wholetext", True)
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    files = reader.load(folder).select(F.col("_metadata.file_path").alias("source"), "value")
    query = files.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(lambda df, n: handle(lines_of(df, "source", "value"), n)).start()
    query.awaitTermination()
