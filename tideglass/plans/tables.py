"""Wide sensor tables, month matrices, station inventories, grids, corrected unit values, API pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideglass.functions.scalars import clean_identifier, is_calendar_day, parse_number, qualifiers_json, signed_longitude, slot_interval, strict_number, utc_instant
from tideglass.functions.station_time import civil_to_utc, shift_to_utc, with_standard_offsets
from tideglass.operators.analysis import nearest_grid, overlaps, point_zones
from tideglass.operators.gates import GateError, first_reason
from tideglass.plans.result import ParseResult, rejection
from tideglass.session import kept, shared_path
from tideglass.sources.lines import month_matrix, require_columns
from tideglass.spec import DatasetSpec, DeclarationError


def no_rejections(df: DataFrame) -> DataFrame:
    return df.limit(0).select(*rejection(F.lit(""), F.lit(""), F.lit(""), F.lit(""), F.lit(""), F.lit(0), F.struct(F.lit("").alias("none"))))


def column_map(df: DataFrame, spec: DatasetSpec, mapping: dict[str, str]) -> DataFrame:
    """df with canonical names and types; the mapping must name exactly the declared columns, df must have its sources."""
    wanted = {*spec.variable_names, *(v.quality_field for v in spec.variables if v.quality_field), *(a.name for a in spec.annotations)}
    if set(mapping) != wanted:
        raise DeclarationError(f"{spec.dataset_id}: the column map must name {sorted(wanted)}")
    require_columns(df, [*mapping.values()])
    kinds = {v.name: v.dtype for v in spec.variables} | {a.name: a.dtype for a in spec.annotations}
    cast = lambda name, src: strict_number(F.col(src).cast("string"), name) if kinds.get(name) == "float64" else F.col(src).cast("string")
    return df.withColumns({f"_{name}": cast(name, src) for name, src in mapping.items()}).drop(*mapping.values()).withColumnsRenamed({f"_{name}": name for name in mapping})


def parse_wide(table: DataFrame, spec: DatasetSpec, entity: str, time: str, mapping: dict[str, str], slot: str = "start", duration: str = "10 minutes") -> ParseResult:
    """A wide sensor table with civil times of the dataset's zone, labelled at the start or end of their interval."""
    require_columns(table, [entity, time], [entity])
    named = column_map(table.withColumns({"_entity": F.col(entity), "_time": F.col(time).cast("timestamp")}), spec, mapping)
    start, end = slot_interval(civil_to_utc(F.col("_time"), spec.timezone), slot, duration)
    names = [f.name for f in spec.struct_type() if f.name not in ("entity_id", "time_start", "time_end")]
    return ParseResult(named.select(F.col("_entity").alias("entity_id"), start.alias("time_start"), end.alias("time_end"), *names), no_rejections(table))


def parse_month_matrix(table: DataFrame, zone: str, variable: str, station: str = "station", year: str = "year", month: str = "month", value_stem: str = "value", flag_stem: str = "flag") -> ParseResult:
    """31 value and flag columns a month to days of a zone; slots beyond the month drop out, null flags are empty."""
    days = month_matrix(table, station, year, month, value_stem, flag_stem)
    real = days.filter(is_calendar_day(F.col("year"), F.col("month"), F.col("day")))
    at = F.make_date("year", "month", "day")
    accepted = real.select(F.col("station").alias("entity_id"), civil_to_utc(at.cast("timestamp"), zone).alias("time_start"), civil_to_utc(F.date_add(at, 1).cast("timestamp"), zone).alias("time_end"), F.col("value").alias(variable), F.col("flag").alias(f"{variable}_quality"))
    return ParseResult(accepted, no_rejections(table))


def parse_inventory(table: DataFrame, mapping: dict[str, str], numbers: Sequence[str] = (), longitude: str | None = None, convention: str = "signed", polygons: DataFrame | None = None, latitude: str = "latitude") -> DataFrame:
    """A reference table: one row an entity, ids cleaned, numbers typed, longitudes signed, zones from polygons if given."""
    require_columns(table, [*mapping.values()])
    typed = lambda name, src: clean_identifier(F.col(src)) if name == "entity_id" else parse_number(F.col(src).cast("string")) if name in numbers else F.nullif(F.trim(F.col(src).cast("string")), F.lit(""))
    out = table.select(*(typed(name, src).alias(name) for name, src in mapping.items()))
    if longitude:
        out = out.withColumn(longitude, signed_longitude(F.col(longitude), convention))
    if polygons is not None:
        out = out.join(point_zones(out, polygons, "entity_id", longitude or "longitude", latitude), "entity_id", "left")
    stop = F.raise_error(F.concat(F.lit("an entity has no id: "), F.to_json(F.struct(*(c for c in out.columns if c != "entity_id"))))).cast("string")
    return out.withColumn("entity_id", F.coalesce("entity_id", stop))


def parse_grid(grid: DataFrame, targets: DataFrame, value: str, unit_col: str, unit: str, axes: Sequence[tuple[str, str]], time: str = "time", duration: str = "1 hour", slot: str = "end", **sums: Column) -> DataFrame:
    """A gridded variable at the grid point nearest each target; every row must be in the declared unit.

    sums: aggregates of the grid's rows by name, in place of the values; there is a row a target and time then.
    """
    stop = F.raise_error(F.concat(F.lit("unit is not as declared: "), F.coalesce(F.col(unit_col), F.lit("none"))))
    start, end = slot_interval(F.col(time), slot, duration)
    if sums:
        fine = grid.filter(F.when(F.col(unit_col) == unit, True).otherwise(stop.cast("boolean")))
        return nearest_grid(fine, targets, axes, [time], **sums).select("entity_id", start.alias("time_start"), end.alias("time_end"), *sums)
    fine = F.when(F.col(unit_col) == unit, F.col(value)).otherwise(stop.cast("double"))
    return nearest_grid(grid, targets, axes).select("entity_id", start.alias("time_start"), end.alias("time_end"), fine.alias(value))


def select_members(members: DataFrame, areas: DataFrame, station: str, limit: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(selected members, one row of counts): members by drainage area; without a limit all are selected.

    Counts are disjoint: selected, unmatched (no such station), unknown_area, excluded. Station ids of the areas have to
    be of the members' type, and text unless the members' are numbers by declaration; one station has one area.
    """
    own, theirs = dict(members.dtypes)[station], dict(areas.dtypes)["station"]
    if own != theirs:
        raise DeclarationError(f"station ids of members are {own}, those of areas {theirs}")
    joined = members.join(areas.select(F.col("station").alias(station), "area", F.lit(True).alias("matched")), station, "left")
    kind = F.lit("selected") if limit is None else F.when(F.col("matched").isNull(), "unmatched").when(F.col("area").isNull(), "unknown_area").when(F.col("area") <= limit, "selected").otherwise("excluded")
    classed = joined.withColumn("class", kind)
    counts = classed.agg(*(F.count_if(F.col("class") == c).alias(c) for c in ("selected", "unmatched", "unknown_area", "excluded")))
    return classed.filter("class = 'selected'").select(*members.columns), counts


def selection_fingerprint(members: DataFrame, columns: Sequence[str], parameters: dict, prefix: int = 2, most: int = 4096) -> DataFrame:
    """One row with a digest of member rows, in whatever order they come, and parameters.

    A tree of digests: a leaf digests the sorted row digests that share their leading hexadecimal digits, an inner node
    the digests of its children, down to nodes of `prefix` digits, whose digests in order make the result. Leaves get as
    many digits more as it takes to hold about `most` distinct rows, so no group grows with the table. Equal rows are
    counted with their digest, so that many of them are one entry; a row that occurs once is its digest alone.
    """
    import json

    digests = members.select(F.sha2(F.to_json(F.struct(*columns)).cast("binary"), 256).alias("row")).groupBy("row").agg(F.count("*").alias("n"))
    counted = kept(digests.select(F.when(F.col("n") == 1, F.col("row")).otherwise(F.concat_ws("*", "row", F.col("n").cast("string"))).alias("row")), "digests")
    rows, depth = counted.count(), prefix
    while rows > most * 16**depth:
        depth += 1
    joined = lambda key: F.sha2(F.array_join(F.sort_array(F.collect_list(key)), ",").cast("binary"), 256)
    level = counted.groupBy(F.substring("row", 1, depth).alias("lead")).agg(joined("row").alias("digest"))
    for digits in range(depth - 1, prefix - 1, -1):
        children = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("lead", "digest"))), lambda x: x["digest"]), ",")  # 16 at most
        level = level.groupBy(F.substring("lead", 1, digits).alias("_lead")).agg(F.sha2(children.cast("binary"), 256).alias("digest")).withColumnRenamed("_lead", "lead")
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("lead", "digest"))), lambda x: x["digest"]), ",")  # 16 ** prefix
    return level.agg(F.sha2(F.concat_ws("|", whole, F.lit(json.dumps(parameters, sort_keys=True, default=str))).cast("binary"), 256).alias("fingerprint"))


def parse_unit_values(rows: DataFrame, station: Column, qualifier_at: int = 5, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of commented CSV (cells: instant, local time, value, approval, grade, qualifiers ...) as instants, with further columns to keep."""
    cell = lambda k: F.get("cells", F.lit(k))
    at = utc_instant(cell(0))
    fine = F.when(at.isNotNull(), at).otherwise(F.raise_error(F.concat(F.lit("no UTC instant: "), F.coalesce(cell(0), F.lit("none")))).cast("timestamp"))
    return rows.select(station.alias("entity_id"), fine.alias("time_start"), strict_number(F.nullif(F.trim(cell(2)), F.lit("")), "value").alias("value"), cell(3).alias("approval"), cell(4).alias("grade"), qualifiers_json(F.col("cells"), qualifier_at).alias("qualifiers"), *keep)


def check_page_rows(rows: DataFrame, requested: str = "climate_id", parts: Sequence[str] = (), key: str | None = None, coordinates: tuple[str, str, str, str] | None = None) -> DataFrame:
    """Page rows (source, row_number, climate_id, local_date, window_start, window_end, ...) with their first fault.

    local is the parsed clock. A row must be of the requested station, parse, stand on a whole minute inside its window,
    and be the only one of its hour in the window. parts names columns of year, month, day and hour, and key a composed id
    station.year.month.day.hour, that must say the same; coordinates names longitude, latitude and those published.
    """
    from pyspark.sql import Window

    from tideglass.functions.scalars import same_coordinate, whole_within

    seen = rows.withColumn("local", F.try_to_timestamp("local_date", F.lit("yyyy-MM-dd HH:mm:ss")))
    seen = seen.withColumn("_twice", F.count("*").over(Window.partitionBy("window_start", requested, "local")) > 1)
    clock = [f("local") for f in (F.year, F.month, F.dayofmonth, F.hour)]
    rules = [
        ("other_station", F.col("station_id") != F.col(requested)), ("unreadable_date", F.col("local").isNull()), ("not_a_whole_minute", F.second("local") != 0),
        ("outside_window", ~((F.col("local") >= F.col("window_start")) & (F.col("local") < F.col("window_end")))), ("repeated_hour", F.col("_twice")),
        *((f"{c}_disagrees", ~whole_within(F.col(c), 0, 9999) | (F.col(c).try_cast("int") != at)) for c, at in zip(parts, clock, strict=False)),
    ]
    if key:
        rules.append(("key_disagrees", F.format_string("%s.%d.%d.%d.%d", F.col("station_id"), *clock) != F.col(key)))
    if coordinates:
        x, y, own_x, own_y = map(F.col, coordinates)
        rules.append(("coordinates_disagree", ~(same_coordinate(x, own_x) & same_coordinate(y, own_y))))
    return seen.withColumn("fault", first_reason(*rules)).drop("_twice")


def refuse_faults(checked: DataFrame) -> DataFrame:
    """The rows of check_page_rows; one with a fault ends the job and names its page and row."""
    stop = F.raise_error(F.concat_ws(" ", F.col("source"), F.lit("row"), F.col("row_number").cast("string"), "fault")).cast("timestamp")
    return checked.withColumn("local", F.when(F.col("fault").isNull(), F.col("local")).otherwise(stop)).drop("fault")


def scoped_values(rows: DataFrame, numbers: Sequence[str], markers: dict[str, Sequence[str]]) -> DataFrame:
    """rows with columns as strict numbers; a text marker gives null in the columns that it is named for and ends the job elsewhere."""
    if unknown := {c for own in markers.values() for c in own} - {*numbers}:
        raise DeclarationError(f"markers for undeclared columns: {sorted(unknown)}")
    scope = lambda c: [m for m, own in markers.items() if c in own]
    text = lambda c: F.when(~F.trim(c).isin([*scope(c), ""]), F.trim(c)) if c in rows.columns else F.lit(None).cast("string")
    return rows.withColumns({c: strict_number(text(c), c) for c in numbers})


def verify_counts(counts: DataFrame, pages: DataFrame, keys: Sequence[str]) -> None:
    """Ends the job, with up to three examples, unless the rows of each window are as many as were published."""
    if bad := reconcile_windows(counts, pages, keys).filter(~F.col("complete")).limit(3).collect():
        raise GateError(f"pages and counts differ: {[tuple(map(str, r)) for r in bad]}")


def page_accounts(result: ParseResult, rows: DataFrame, page: str = "source") -> DataFrame:
    """Per page: physical rows, published ones, those set aside and for which reason, and whether the sums agree."""
    total = rows.groupBy(page).agg(F.count("*").alias("physical"))
    out = result.accepted.groupBy(page).agg(F.count("*").alias("published"))
    lost = result.rejected.groupBy("source", "reason").agg(F.count("*").alias("n")).groupBy("source").agg(F.sum("n").alias("set_aside"), F.array_join(F.sort_array(F.collect_list(F.concat_ws(":", "reason", F.col("n").cast("string")))), ",").alias("reasons"))
    joined = total.join(out, page, "left").join(lost.withColumnRenamed("source", page), page, "left")
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    made = joined.select(page, "physical", n("published"), n("set_aside"), F.coalesce("reasons", F.lit("")).alias("reasons"))
    return made.withColumn("balanced", F.col("physical") == F.col("published") + F.col("set_aside"))


def value_counts(rows: DataFrame, page: str, columns: Sequence[str]) -> DataFrame:
    """(page, column, value, n) of the non-blank values of the given columns."""
    cells = rows.select(page, F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.trim(F.col(c).cast("string")).alias("value")) for c in columns))))
    return cells.filter("value <> ''").groupBy(page, "column", "value").agg(F.count("*").alias("n"))


def refuse_varying(rows: DataFrame, page: str, constants: Sequence[str]) -> None:
    """Ends the job if a column that has to be constant in a page holds several values."""
    several = [F.count_distinct(c).alias(c) for c in constants]
    bad = rows.groupBy(page).agg(*several).filter(" OR ".join(f"`{c}` > 1" for c in constants)).limit(3).collect()
    if bad:
        raise GateError(f"columns vary within pages: {[r.asDict() for r in bad]}")


def placed_rows(rows: DataFrame, zones: DataFrame, duration: str = "1 hour", publisher_utc: str | None = None) -> DataFrame:
    """Rows with a local standard clock at their interval's end, with time_start, time_end and the reason to set them aside.

    Each end gets its own day's offset. Rows without zone, rows whose interval would change its length, and rows whose
    instant isn't the publisher's have a reason, all others none.
    """
    begin = F.col("local") - F.expr(f"INTERVAL {duration}")
    both = rows.withColumns({"_begin": begin, "_day": F.to_date(begin), "_end_day": F.to_date("local")}).join(zones.select("entity_id", "zone"), "entity_id", "left")
    placed = with_standard_offsets(both, "zone", "_day").withColumnsRenamed({"offset_start": "_own", "offset_end": "_next"}).drop("is_transition")
    end_offset = F.when(F.col("_end_day") > F.col("_day"), F.col("_next")).otherwise(F.col("_own"))
    start, end = shift_to_utc(F.col("_begin"), F.col("_own")), shift_to_utc(F.col("local"), end_offset)
    placed = placed.withColumns({"time_start": start, "time_end": end})
    changed = F.unix_micros("time_end") - F.unix_micros("time_start") != F.unix_micros("local") - F.unix_micros("_begin")
    rules = [("missing_station_timezone", F.col("zone").isNull()), ("standard_timezone_transition", changed)]
    if publisher_utc:
        rules.append(("publisher_utc_mismatch", F.try_to_timestamp(F.col(publisher_utc), F.lit("yyyy-MM-dd HH:mm:ss")) != F.col("time_end")))
    return placed.withColumn("reason", first_reason(*rules)).drop("_begin", "_day", "_end_day", "_own", "_next")


def split_by_reason(placed: DataFrame) -> ParseResult:
    """placed_rows as a result: those with a reason are rejections, located by their row."""
    locator = F.concat(F.lit("row:"), F.col("row_number").cast("string"))
    lost = placed.filter("reason IS NOT NULL").select(*rejection(F.col("source"), locator, F.lit("row"), F.col("reason"), F.col("local").cast("string"), F.lit(0), F.struct("entity_id")))
    return ParseResult(placed.filter("reason IS NULL").drop("reason"), lost)


def place_page_rows(rows: DataFrame, zones: DataFrame, duration: str = "1 hour", publisher_utc: str | None = None) -> ParseResult:
    """Rows with a local standard clock at their interval's end to UTC intervals; see placed_rows for what is set aside."""
    return split_by_reason(placed_rows(rows, zones, duration, publisher_utc))


def page_windows(requests: DataFrame) -> DataFrame:
    """(entity_id, window_start, window_end) of requests (entity_id, start, end), split at each 1 January.

    The same request counts once. A request without id, with a bound off the whole hour, or without a later end ends the
    job. The end is exclusive; inclusive_end gives the last second that a publisher's inclusive request names.
    """
    whole = lambda c: F.date_trunc("hour", F.col(c)) == F.col(c)
    fault = first_reason(("no_id", F.col("entity_id").isNull() | (F.trim("entity_id") == "")), ("not_a_whole_hour", ~(whole("start") & whole("end"))), ("end_not_behind_start", ~(F.col("end") > F.col("start"))))
    named = requests.distinct().withColumn("_fault", fault)
    stop = F.raise_error(F.concat_ws(" ", F.lit("request"), F.coalesce("entity_id", F.lit("without id")), F.col("start").cast("string"), F.col("end").cast("string"), "_fault")).cast("timestamp")
    fine = named.withColumn("start", F.when(F.col("_fault").isNull(), F.col("start")).otherwise(stop))
    years = fine.withColumn("y", F.explode(F.sequence(F.year("start"), F.year(inclusive_end(F.col("end"))))))
    edge = lambda y: F.make_timestamp(y, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return years.select("entity_id", F.greatest("start", edge(F.col("y"))).alias("window_start"), F.least("end", edge(F.col("y") + 1)).alias("window_end"))


def inclusive_end(end: Column) -> Column:
    """The last second before an exclusive end."""
    return end - F.expr("INTERVAL '1' SECOND")


def retrieval_order(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rows with place: their number from 1 in the order of the keys. Rows are counted by ranges; no task sorts them all."""
    from pyspark.sql import Window

    dealt = rows.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id())
    path = shared_path(rows.sparkSession, "ordered")  # written, as ranges are sampled anew whenever a plan runs
    dealt.write.parquet(path)
    kept = rows.sparkSession.read.parquet(path)
    counts = kept.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
    return kept.withColumn("_place", place).join(before, "_part").withColumn("place", (F.col("_base") + F.col("_place")).cast("long")).drop("_part", "_place", "_base")


def settled(end: Column, retrieved: Column, days: int) -> Column:
    return retrieved >= end + F.expr(f"INTERVAL '{days}' DAY")


def check_manifest(manifest: DataFrame, page_limit: int) -> DataFrame:
    """Windows (climate_id, window_start) of a manifest with their first fault: counts and pages must prove completeness.

    manifest: climate_id, window_start, role (hits or page), page_offset, number_matched. One count a window, and pages
    at exactly 0, page_limit, 2 * page_limit ... below it. Where they are columns too, file_name has to be a plain name
    that occurs once, sha256 64 hexadecimal digits, and window_end a later instant of the same calendar year, with no
    two windows of a station overlapping.
    """
    more = []
    if "file_name" in manifest.columns:
        from tideglass.plans.members import safe_name

        names = manifest.groupBy(F.col("file_name").alias("_name")).agg((F.count("*") > 1).alias("_twice"))
        manifest = manifest.join(names, F.col("file_name").eqNullSafe(F.col("_name"))).drop("_name")
        more += [F.bool_or(~safe_name(F.col("file_name"))).alias("unsafe_name"), F.bool_or("_twice").alias("repeated_name")]
    if "sha256" in manifest.columns:
        more.append(F.bool_or(~F.coalesce(F.col("sha256").rlike("^[0-9a-f]{64}$"), F.lit(False))).alias("bad_digest"))
    if "window_end" in manifest.columns:
        within = (F.col("window_end") > F.col("window_start")) & (F.year("window_start") == F.year(inclusive_end(F.col("window_end"))))
        windows = manifest.select("climate_id", "window_start", "window_end").distinct()
        crossed = overlaps(windows, "climate_id", "window_start", "window_end", "year").select(F.col("climate_id").alias("_id"), F.col("start").alias("_start")).distinct()
        manifest = manifest.join(crossed, (F.col("climate_id") == F.col("_id")) & (F.col("window_start") == F.col("_start")), "left").withColumn("_crossed", F.col("_id").isNotNull()).drop("_id", "_start")
        more += [F.bool_or(~F.coalesce(within, F.lit(False))).alias("not_within_a_year"), F.bool_or("_crossed").alias("overlapping_window")]
    per = manifest.groupBy("climate_id", "window_start").agg(
        F.count_if(F.col("role") == "hits").alias("counts"), F.max(F.when(F.col("role") == "hits", F.col("number_matched"))).alias("matched"), F.count_distinct("number_matched").alias("kinds"),
        F.sort_array(F.collect_list(F.when(F.col("role") == "page", F.col("page_offset").cast("long")))).alias("offsets"), *more,
    )
    wanted = F.when(F.col("matched") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.floor((F.col("matched") - 1) / page_limit)), lambda k: k * page_limit)).otherwise(F.array().cast("array<bigint>"))
    faults = [(c, F.col(c)) for c in ("unsafe_name", "repeated_name", "bad_digest", "not_within_a_year", "overlapping_window") if c in per.columns]
    fault = first_reason(*faults, ("no_single_count", F.col("counts") != 1), ("counts_disagree", F.col("kinds") > 1), ("pages_incomplete", F.col("offsets") != wanted))
    return per.select("climate_id", "window_start", "matched", F.size("offsets").cast("long").alias("n_pages"), fault.alias("fault"))


def page_profile(rows: DataFrame, page: str, published: Column, day: str, flags: Sequence[str], constants: Sequence[str]) -> DataFrame:
    """Per page: rows, published, first and last day, non-blank flags, and whether its constant columns hold one value."""
    return rows.groupBy(page).agg(
        F.count("*").alias("n_rows"), F.count_if(published).alias("n_published"), F.count_if(~published).alias("n_set_aside"), F.min(day).alias("first_day"), F.max(day).alias("last_day"),
        *(F.count_if(F.trim(f) != "").alias(f"{f}_count") for f in flags), *((F.count_distinct(c) <= 1).alias(f"{c}_constant") for c in constants),
    )


def reconcile_windows(counts: DataFrame, pages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, matched, n_rows, complete): published counts against the rows that pages gave, none counting as 0."""
    got = pages.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    joined = counts.join(got, [*keys], "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    return joined.select(*keys, "matched", "n_rows", (F.col("matched") == F.col("n_rows")).alias("complete"))
