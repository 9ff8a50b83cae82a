"""What every parse job returns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideglass.functions.scalars import raw_digest

REJECTION = "rejection_key string, record_locator string, reason string, raw_sha256 string, raw_length long, recovered_count long, details_json string"


@dataclass(frozen=True)
class ParseResult:
    """accepted: canonical observations; rejected: what was set aside, with where it stood and why."""

    accepted: DataFrame
    rejected: DataFrame


def rejection(source: Column, locator: Column, key: Column, reason: Column, raw: Column, recovered: Column, details: Column) -> list[Column]:
    return [
        source.alias("source"), F.concat_ws(":", locator, key).alias("rejection_key"), locator.alias("record_locator"), reason.alias("reason"), raw_digest(raw).alias("raw_sha256"),
        F.char_length(raw).cast("long").alias("raw_length"), recovered.cast("long").alias("recovered_count"), F.to_json(details).alias("details_json"),
    ]
