"""Comparisons, profiles and series operators that readers of observations use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideglass.operators import ranges


def compare_sources(left: DataFrame, right: DataFrame, keys: Sequence[str], variables: Sequence[str], digits: int | None = None) -> DataFrame:
    """(variable, class, n): per variable, how many keys are equal, differ, stand left only or right only, or are null in both."""
    pair = lambda df, side: df.select(*keys, F.struct(*variables).alias(side))
    both = pair(left, "l").join(pair(right, "r"), [*keys], "full_outer")
    value = lambda side, v: F.col(f"{side}.{v}") if digits is None else F.round(F.col(f"{side}.{v}"), digits)

    def kind(v: str) -> Column:
        a, b = value("l", v), value("r", v)
        return F.when(a.isNull() & b.isNull(), "both_null").when(b.isNull(), "left_only").when(a.isNull(), "right_only").when(a == b, "equal").otherwise("differ")

    rows = both.select(F.inline(F.array(*(F.struct(F.lit(v).alias("variable"), kind(v).alias("class")) for v in variables))))
    return rows.groupBy("variable", "class").agg(F.count("*").alias("n"))


def flag_distribution(df: DataFrame, pattern: str) -> DataFrame:
    """(field, flag, n): non-blank values of all columns whose name matches."""
    import re

    fields = [c for c in df.columns if re.fullmatch(pattern, c)]
    rows = df.select(F.inline(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("flag")) for c in fields))))
    return rows.filter(F.trim("flag") != "").groupBy("field", "flag").agg(F.count("*").alias("n"))


def value_profile(df: DataFrame, by: str, value: str, quantiles: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """Per group: n, least, most and exact quantiles named p50 and so on; see ranges.quantiles."""
    found = ranges.quantiles(df, by, value, quantiles)
    cuts = [F.max(F.when(F.col("q") == float(q), F.col("measured"))).alias(f"p{round(q * 100)}") for q in quantiles]
    whole = df.filter(F.col(value).isNotNull()).groupBy(by).agg(F.count("*").alias("n"), F.min(value).alias("least"), F.max(value).alias("most"))
    wide = found.groupBy(F.col(by).alias("_by")).agg(*cuts)
    return whole.join(wide, F.col(by).eqNullSafe(F.col("_by"))).drop("_by")


def counts_where(df: DataFrame, by: Sequence[str], conditions: dict[str, Column], value: str | None = None) -> DataFrame:
    """Per group (or over all rows): n, how many rows meet each named condition, and of a value how many, the least and the most.

    A condition that is null counts as not met. One pass, summed before the shuffle.
    """
    made = [F.count("*").alias("n"), *(F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in conditions.items())]
    if value is not None:
        made += [F.count(value).alias("n_values"), F.min(value).alias("least"), F.max(value).alias("most")]
    return df.groupBy(*by).agg(*made)


def cardinalities(df: DataFrame, entity: str, keys: Sequence[str]) -> DataFrame:
    """One row: n_rows, n_entities, n_keys. Rows with a null in a key count in n_rows alone.

    Keys are made distinct first and counted by entity, so no task sees them all.
    """
    distinct = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    whole = F.when(F.forall(F.array(*(F.col(k).isNotNull() for k in keys)), lambda x: x), F.lit(1)).otherwise(0)
    by_entity = distinct.groupBy(entity).agg(F.sum("_rows").alias("_rows"), F.sum(whole).alias("_keys"))
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return by_entity.agg(n("_rows").alias("n_rows"), F.count(entity).alias("n_entities"), n("_keys").alias("n_keys"))


def enriched(rows: DataFrame, inventory: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """rows with the attributes of their entity; null where the inventory lacks it. An inventory that has a key twice ends the job."""
    twice = F.raise_error(F.concat(F.lit(f"{key} occurs twice in the inventory: "), F.col(key).cast("string"))).cast("boolean")
    once = inventory.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"), *(F.first(a).alias(a) for a in attributes))
    checked = once.filter(F.when(F.col("_n") == 1, True).otherwise(twice)).drop("_n")
    return rows.join(checked.withColumnRenamed(key, "_key"), F.col(key) == F.col("_key"), "left").drop("_key")


def newest(df: DataFrame, by: str, at: str, columns: Sequence[str]) -> DataFrame:
    """(by, columns) of each group's latest row, of equally late ones the greatest; one aggregation, no sort."""
    last = df.groupBy(by).agg(F.max(F.struct(at, *columns)).alias("_last"))
    return last.select(by, *(F.col(f"_last.{c}").alias(c) for c in columns))


def record_summary(entities: DataFrame, records: DataFrame, key: str, conditions: dict[str, Column]) -> DataFrame:
    """One row: entities, those with a record that meets each condition, and those without any record."""
    flags = records.groupBy(F.col(key).alias("_key")).agg(*(F.coalesce(F.bool_or(c), F.lit(False)).alias(f"_{name}") for name, c in conditions.items()))
    rows = entities.join(flags, F.col(key) == F.col("_key"), "left")
    return rows.agg(F.count("*").alias("n"), *(F.count_if(F.coalesce(f"_{name}", F.lit(False))).alias(name) for name in conditions), F.count_if(F.col("_key").isNull()).alias("without_any"))


def leading(counted: DataFrame, count: str, name: str, most: int) -> DataFrame:
    """The groups of the greatest counts, ties by name: a report of a stated length."""
    return counted.orderBy(F.col(count).desc(), name).limit(most)


def coverage(df: DataFrame, time: str, by: Sequence[str], value: str, period: str = "year") -> DataFrame:
    """Per group and period: all rows and non-null values."""
    return df.groupBy(*by, F.date_trunc(period, time).alias("period")).agg(F.count("*").alias("n_rows"), F.count(value).alias("n_values"))


def _spans(df: DataFrame, entity: str, start: str, end: str, every: str) -> DataFrame:
    """(entity, start, end, _range) of whole spans."""
    rows = df.select(F.col(entity), F.col(start).alias("start"), F.col(end).alias("end")).filter("start IS NOT NULL AND end IS NOT NULL")
    return ranges.segments(rows, "start", every)


def gaps(df: DataFrame, entity: str, start: str, end: str, every: str = "day") -> DataFrame:
    """(entity, gap_start, gap_end): between the end of an interval and the next one's later start.

    An entity's spans are dealt to tasks by the calendar day (or `every` else) that they start on; what was reached
    before a day, and the next day's first start, are carried over. The same holds for merged_spans and overlaps. Spans
    without start or end count as none.
    """
    rows = ranges.carry(_spans(df, entity, start, end, every), entity, _reached=(F.max("end"), "max_before"), _next=(F.min("start"), "next"))
    order = ranges.in_segment(entity, "start", "end")
    reached = F.greatest(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, 0)), "_reached")
    found = rows.select(entity, reached.alias("gap_start"), F.coalesce(F.lead("start").over(order), "_next").alias("gap_end"))
    return found.filter("gap_end > gap_start")


def _before(rows: DataFrame, entity: str) -> DataFrame:
    """rows of _spans with earlier_end: the greatest end of the entity's spans before."""
    order = ranges.in_segment(entity, "start", "end").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.carry(rows, entity, _reached=(F.max("end"), "max_before")).withColumn("earlier_end", F.greatest(F.max("end").over(order), "_reached")).drop("_reached")


def merged_spans(df: DataFrame, entity: str, start: str, end: str, every: str = "day") -> DataFrame:
    """(entity, start, end): spans that overlap or touch, as one."""
    seen = _before(_spans(df, entity, start, end, every), entity)
    opens = F.when(F.col("earlier_end").isNull() | (F.col("start") > F.col("earlier_end")), F.col("start"))
    order = ranges.in_segment(entity, "start", "end").rowsBetween(Window.unboundedPreceding, 0)
    marked = seen.withColumn("_opened", F.max(opens).over(order))
    since = ranges.carry(marked, entity, _since=(F.max("_opened"), "last")).withColumn("_island", F.coalesce("_opened", "_since"))
    return since.groupBy(entity, "_island").agg(F.max("end").alias("end")).select(entity, F.col("_island").alias("start"), "end")


def overlaps(df: DataFrame, entity: str, start: str, end: str, every: str = "day") -> DataFrame:
    """(entity, start, end, earlier_end): spans that start before an earlier one of the same entity has ended."""
    return _before(_spans(df, entity, start, end, every), entity).select(entity, "start", "end", "earlier_end").filter("start < earlier_end")


def uncovered(published: DataFrame, selection: DataFrame, entity: str, every: str = "day") -> DataFrame:
    """Published (entity, start, end) that lie in no merged span of the selection.

    Merged spans are apart, so only the last one that starts no later than a range can hold it: both stand in one order,
    and the last span before a day is carried into it.
    """
    spans = merged_spans(selection, entity, "start", "end", every).select(entity, F.col("start").alias("_at"), F.struct("start", "end").alias("_span"), F.lit(None).cast(published.select(F.struct("*")).schema[0].dataType).alias("_row"))
    asked = published.select(entity, F.col("start").alias("_at"), F.lit(None).cast(spans.schema["_span"].dataType).alias("_span"), F.struct("*").alias("_row"))
    both = ranges.carry(ranges.segments(spans.unionByName(asked), "_at", every), entity, _carried=(F.max("_span"), "last"))
    order = ranges.in_segment(entity, "_at", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    held = both.withColumn("_in", F.coalesce(F.last("_span", ignorenulls=True).over(order), "_carried")).filter("_row IS NOT NULL")
    inside = (F.col("_row.start") >= F.col("_in.start")) & (F.col("_row.end") <= F.col("_in.end"))
    return held.filter(~F.coalesce(inside, F.lit(False))).select("_row.*")


def onset_contrast(df: DataFrame, entity: str, time: str, wet: str, others: Sequence[str], step: str = "1 hour", every: str = "day") -> DataFrame:
    """One row: how many periods are wet behind a dry one, and the mean changes of other variables around them."""
    names = [*dict.fromkeys((wet, *others))]
    rows = ranges.neighbours(df.select(entity, time, *names), entity, time, names, every)
    span = F.expr(f"INTERVAL {step}")
    beside = (F.col(f"_before.{time}") == F.col(time) - span) & (F.col(f"_after.{time}") == F.col(time) + span)
    onsets = rows.filter(beside & (F.col(wet) > 0) & (F.col(f"_before.{wet}") == 0))
    changes = lambda v: {f"{v}_change": F.col(v) - F.col(f"_before.{v}"), f"{v}_after": F.col(f"_after.{v}") - F.col(v)}
    return onsets.agg(F.count("*").alias("n"), *(F.avg(c).alias(name) for v in others for name, c in changes(v).items()))


def _corner(axis: str):
    return lambda p: p[axis]


def nearest_grid(grid: DataFrame, targets: DataFrame, axes: Sequence[tuple[str, str]], by: Sequence[str] = (), **sums: Column) -> DataFrame:
    """targets with the grid's rows at the nearest coordinates of each axis; of two equally near the lower one.

    axes: (grid column, target column). Each axis is one join of orders (ranges.nearest_values), the rest are joins by
    equal coordinates. Targets without a coordinate find nothing.

    sums: aggregates of the grid's rows by name. The rows of a coordinate (and of equal values of the columns in `by`) are
    then summed up before targets meet them, so the result has a row a target and group, and no target meets each grid row.
    """
    at = targets
    for g, t in axes:
        near = ranges.nearest_values(grid.select(g), targets.select(t)).withColumnsRenamed({"aim": f"aim_{g}", "near": f"near_{g}"})
        at = at.join(near, F.col(t).cast("double") == F.col(f"aim_{g}")).drop(f"aim_{g}")
    if sums:
        grid = grid.groupBy(*(g for g, _ in axes), *by).agg(*(made.alias(name) for name, made in sums.items()))
    on = [grid[g].cast("double") == at[f"near_{g}"] for g, _ in axes]
    return grid.join(at, on).drop(*(f"near_{g}" for g, _ in axes))


def in_polygon(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point lies inside a ring of (lon, lat) structs, by the parity of edges to its east."""
    n = F.size(ring)

    def crossed(i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, (i + 1) % n)
        above = (a["lat"] > y) != (b["lat"] > y)
        edge = (b["lon"] - a["lon"]) * (y - a["lat"]) / F.nullif(b["lat"] - a["lat"], F.lit(0.0)) + a["lon"]
        return F.when(above & (x < edge), 1).otherwise(0)

    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), crossed), F.lit(0), lambda s, v: s + v) % 2 == 1


def point_zones(points: DataFrame, polygons: DataFrame, key: str, lon: str, lat: str, cell: tuple[float, float] = (1.0, 1.0)) -> DataFrame:
    """(key, zone): the name of the polygon (zone, ring) a point lies in, the first by name; null outside of all or without coordinates.

    Points and the boxes around polygons are dealt to cells of the given width and height, and meet by equal cells; only
    the polygons of a point's own cell are tried. A polygon is a row for each cell that its box touches.
    """
    boxes = polygons.select("zone", "ring", *(f(F.transform("ring", _corner(c))).alias(f"{n}_{c}") for c in ("lon", "lat") for n, f in (("low", F.array_min), ("high", F.array_max))))
    number = lambda c, size: F.floor(c / F.lit(float(size)))
    for axis, size in zip(("lon", "lat"), cell, strict=True):
        boxes = boxes.withColumn(f"_cell_{axis}", F.explode(F.sequence(number(F.col(f"low_{axis}"), size), number(F.col(f"high_{axis}"), size))))
    at = points.select(key, F.col(lon).alias("_lon"), F.col(lat).alias("_lat"), number(F.col(lon), cell[0]).alias("_cell_lon"), number(F.col(lat), cell[1]).alias("_cell_lat"))
    inside = F.col("_lon").between(F.col("low_lon"), F.col("high_lon")) & F.col("_lat").between(F.col("low_lat"), F.col("high_lat"))
    hits = at.join(boxes, ["_cell_lon", "_cell_lat"]).filter(inside & in_polygon(F.col("_lon"), F.col("_lat"), F.col("ring"))).groupBy(key).agg(F.min("zone").alias("zone"))
    return points.select(key).join(hits, key, "left")
