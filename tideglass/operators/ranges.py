"""Operators on ordered values that no task has to see whole: sampled ranges, and what is carried from one to the next.

Rows are dealt to ranges of their keys; each range is summed up in a row; windows over those few rows carry to each
range what stands before or behind it. Only then are the ranges themselves looked into, and only those that matter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideglass.session import kept

_PART = "_range"


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df with _range, written in files by range: rows of later ranges have greater keys. Rows that agree in all keys stay together."""
    return kept(df.repartitionByRange(*keys).withColumn(_PART, F.spark_partition_id()), "ranges", _PART)


def quantiles(df: DataFrame, by: str, value: str, wanted: Sequence[float] | Mapping[str, Sequence[float]]) -> DataFrame:
    """(by, q, measured, n): exact quantiles of each group's non-null values, interpolated between neighbours; n counts them.

    wanted: quantiles of all groups, or those of each group by name (other groups are left out). Equal values meet as one
    weighted row before they are dealt to ranges; sums over ranges tell which of them hold the wanted ranks, and only
    those are ordered, each by itself. No task holds a group's values.
    """
    rows = df.filter(F.col(value).isNotNull())
    if isinstance(wanted, Mapping):
        rows = rows.filter(F.col(by).isin([*wanted]))
        lists = F.coalesce(*(F.when(F.col(by) == name, F.array(*map(F.lit, map(float, qs)))) for name, qs in wanted.items())) if wanted else F.array().cast("array<double>")
    else:
        lists = F.array(*map(F.lit, map(float, wanted)))
    counted = dealt(rows.groupBy(by, value).agg(F.count("*").alias("_c")), by, value)
    sums = counted.groupBy(by, _PART).agg(F.sum("_c").alias("_sum"))  # a row a group and range
    order = Window.partitionBy(by).orderBy(_PART)
    bounds = sums.withColumns({"_upto": F.sum("_sum").over(order.rowsBetween(Window.unboundedPreceding, 0)), "n": F.sum("_sum").over(Window.partitionBy(by))})
    bounds = bounds.withColumn("_base", F.col("_upto") - F.col("_sum"))
    ranks = bounds.withColumn("q", F.explode(lists)).withColumn("_at", F.col("q") * (F.col("n") - 1))
    low, high = F.floor("_at"), F.ceil("_at")
    ranks = ranks.withColumn("_rank", F.explode(F.array_distinct(F.array(low, high)))).filter((F.col("_rank") >= F.col("_base")) & (F.col("_rank") < F.col("_upto")))
    aims = ranks.select(F.col(by).alias("_by"), F.col(_PART).alias("_of"), "q", "n", "_at", (F.col("_rank") - F.col("_base")).alias("_place"), "_rank")  # two rows a quantile at most
    ranges = aims.groupBy("_by", "_of").agg(F.collect_list(F.struct("q", "n", "_at", "_place", "_rank")).alias("_aims"))
    inside = counted.join(ranges, F.col(by).eqNullSafe(F.col("_by")) & (F.col(_PART) == F.col("_of"))).drop("_by", "_of")
    running = F.sum("_c").over(Window.partitionBy(by, _PART).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    hits = inside.withColumn("_run", running).withColumn("_aim", F.explode("_aims")).filter((F.col("_aim._place") < F.col("_run")) & (F.col("_aim._place") >= F.col("_run") - F.col("_c")))
    at, rank = F.col("_aim._at"), F.col("_aim._rank")
    pairs = hits.groupBy(by, F.col("_aim.q").alias("q"), F.col("_aim.n").alias("n"), at.alias("_at")).agg(F.max(F.when(rank == F.floor(at), F.col(value))).alias("_low"), F.max(F.when(rank == F.ceil(at), F.col(value))).alias("_high"))
    between = (F.ceil("_at") - F.col("_at")) * F.col("_low") + (F.col("_at") - F.floor("_at")) * F.col("_high")
    return pairs.select(by, "q", F.when(F.floor("_at") == F.ceil("_at"), F.col("_low").cast("double")).otherwise(between.cast("double")).alias("measured"), "n")


def nearest_values(values: DataFrame, aims: DataFrame) -> DataFrame:
    """(aim, near): for each distinct non-null aim the nearest of the values (both one column); of two equally near the lower.

    Both sides stand in one order, dealt to ranges; windows in a range find the last value up to an aim and the first
    from it on, and where a range has none, those of the ranges before and behind it are carried over. No values give
    no rows.
    """
    mark = lambda df, kind: df.select(F.col(df.columns[0]).cast("double").alias("x")).filter("x IS NOT NULL").distinct().withColumn("kind", F.lit(kind))
    rows = dealt(mark(values, 0).unionByName(mark(aims, 1)), "x", "kind")
    own = F.when(F.col("kind") == 0, F.col("x"))
    ends = rows.groupBy(_PART).agg(F.max(own).alias("_most"), F.min(own).alias("_least")).orderBy(_PART).collect()  # a row a range
    before, carried = None, {}
    for r in ends:
        carried[r[0]] = [before, None]
        before = r["_most"] if r["_most"] is not None else before
    behind = None
    for r in reversed(ends):
        carried[r[0]][1] = behind
        behind = r["_least"] if r["_least"] is not None else behind
    carry = rows.sparkSession.createDataFrame([(k, *v) for k, v in carried.items()], f"{_PART} int, _last double, _next double")
    order = Window.partitionBy(_PART).orderBy("x", "kind")
    last = F.last(own, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    following = F.first(own, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    found = rows.withColumns({"_l": last, "_n": following}).filter("kind = 1").join(carry, _PART)
    low, high = F.coalesce("_l", "_last"), F.coalesce("_n", "_next")
    near = F.when(high.isNull() | (F.col("x") - low <= high - F.col("x")), low).otherwise(high)
    return found.select(F.col("x").alias("aim"), near.alias("near")).filter("near IS NOT NULL")


def segments(df: DataFrame, time: str, every: str = "day") -> DataFrame:
    """df with _range: the calendar day (month, year ...) of a time, by which an entity's rows are dealt to tasks."""
    return df.withColumn(_PART, F.date_trunc(every, F.col(time).cast("timestamp")))


def carry(rows: DataFrame, entity: str, **columns: tuple[Column, str]) -> DataFrame:
    """rows of segments() with further columns that sum up an entity's other segments.

    columns: name to (aggregate of a segment, direction). 'max_before' is the greatest aggregate of all segments before,
    'last' the latest non-null one before, 'next' the one of the segment behind. A segment is a row, so an entity's
    window holds as many rows as it has days.
    """
    summed = rows.groupBy(entity, _PART).agg(*(made.alias(name) for name, (made, _) in columns.items()))
    order = Window.partitionBy(entity).orderBy(_PART)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    how = {"max_before": lambda c: F.max(c).over(earlier), "last": lambda c: F.last(c, ignorenulls=True).over(earlier), "next": lambda c: F.lead(c).over(order)}
    summed = summed.select(F.col(entity).alias("_of"), F.col(_PART).alias("_in"), *(how[kind](name).alias(name) for name, (_, kind) in columns.items()))
    return rows.join(summed, F.col(entity).eqNullSafe(F.col("_of")) & F.col(_PART).eqNullSafe(F.col("_in"))).drop("_of", "_in")


def in_segment(entity: str, *order: str):
    """The window over an entity's rows of one segment."""
    return Window.partitionBy(entity, _PART).orderBy(*order)


def neighbours(df: DataFrame, entity: str, time: str, fields: Sequence[str], every: str = "day") -> DataFrame:
    """df with _before and _after: structs of time and fields of the entity's rows before and behind, null at its ends."""
    rows = segments(df, time, every)
    whole = F.struct(time, *fields)
    seen = carry(rows, entity, _first=(F.min(whole), "next"), _last=(F.max(whole), "last"))
    order = in_segment(entity, time, *fields)
    return seen.withColumns({"_before": F.coalesce(F.lag(whole).over(order), "_last"), "_after": F.coalesce(F.lead(whole).over(order), "_first")}).drop("_first", "_last", _PART)
