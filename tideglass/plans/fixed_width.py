"""Fixed-width archives: hourly records of a station, day and element with 24 slots, daily ones of a month with 31.

Lines are classed by their length. A record one short has lost its last, blank flag. Blank overflow is cut off. What else
is wrong ends the job under the policy 'error'; under 'salvage' it is set aside, and valid records inside an overlong
line are taken out, from the left, without overlap. Each step is a column expression; a line is read once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideglass.functions.scalars import NUMBER, days_in_month
from tideglass.functions.station_time import shift_to_utc, with_standard_offsets
from tideglass.operators.gates import first_reason
from tideglass.plans.result import ParseResult, rejection
from tideglass.spec import DatasetSpec, DeclarationError


@dataclass(frozen=True)
class Element:
    """How a source element becomes a variable: its scale and where its interval lies in the slot's hour."""

    code: str
    variable: str
    scale: float
    duration_minutes: int = 60
    start_minute: int | None = None
    end_minute: int | None = None
    before_year: int | None = None
    duration_minutes_before: int | None = None
    missing: tuple[str, ...] = ()

    def __post_init__(self):
        longest = max(self.duration_minutes, self.duration_minutes_before or 0)
        if (self.start_minute is None) == (self.end_minute is None) or min(self.duration_minutes, self.duration_minutes_before or 1) <= 0:
            raise DeclarationError(f"element {self.code}: one position and a positive duration")
        if (self.start_minute is not None and not 0 <= self.start_minute <= 60 - longest) or (self.end_minute is not None and not longest <= self.end_minute <= 60):
            raise DeclarationError(f"element {self.code}: the interval leaves its hour")


def check_elements(elements: tuple[Element, ...], spec: DatasetSpec) -> None:
    """Refuses elements that don't cover the declared variables exactly, repeat a code, or name a marker that reads as a number in some slot only."""
    codes, made = [e.code for e in elements], {e.variable for e in elements}
    problems = [f"element {c} is declared twice" for c in sorted({c for c in codes if codes.count(c) > 1})]
    problems += [f"no element gives {v}" for v in spec.variable_names if v not in made] + [f"{v} is not declared" for v in sorted(made - {*spec.variable_names})]
    problems += [f"element {e.code}: blank or repeated markers" for e in elements if len(set(e.missing)) != len(e.missing) or any(not m.strip() for m in e.missing)]
    problems += [f"element {e.code}: an earlier duration needs the year up to which it holds" for e in elements if (e.before_year is None) != (e.duration_minutes_before is None)]
    if problems:
        raise DeclarationError(f"{spec.dataset_id}: " + "; ".join(problems))


@dataclass(frozen=True)
class Layout:
    """Station, date and element in front, then slots of a value and a flag of one character."""

    slots: int = 24
    station: int = 7
    date: str = "yyyyMMdd"
    element: int = 3
    value: int = 6
    missing: str = "-99999"

    @property
    def front(self) -> int:
        return self.station + len(self.date) + self.element

    @property
    def width(self) -> int:
        return self.front + self.slots * (self.value + 1)


HOURLY, MONTHLY = Layout(), Layout(slots=31, date="yyyyMM")


def _part(record: Column, start: int, size: int) -> Column:
    return F.substring(record, start + 1, size)


def _day_text(record: Column, layout: Layout) -> Column:
    text = _part(record, layout.station, len(layout.date))
    return text if layout.date == "yyyyMMdd" else F.concat(text, F.lit("01"))


def _slots_fine(record: Column, code: Column, layout: Layout, elements: tuple[Element, ...]) -> Column:
    """Whether all slots hold numbers or markers: one regular expression over all of them, chosen by the element.

    Flags give way to a separator first, so that no value runs into the next.
    """
    whole = F.substring(record, F.lit(layout.front + 1), F.lit(layout.slots * (layout.value + 1)))
    joined = F.regexp_replace(whole, rf"(?s)(.{{{layout.value}}}).", "$1\x1f")
    number = NUMBER.strip("^$")

    def pattern(marks: tuple[str, ...]) -> str:
        field = "(?:" + "|".join([number, *(rf"\Q{m}\E" for m in (layout.missing, *marks))]) + ")"
        return rf"^(?: *{field} *\x1f){{{layout.slots}}}$"

    fine = joined.rlike(pattern(()))
    for marks in sorted({e.missing for e in elements if e.missing}):
        fine = F.when(code.isin([e.code for e in elements if e.missing == marks]), joined.rlike(pattern(marks))).otherwise(fine)
    return fine


def structural_error(record: Column, layout: Layout, elements: tuple[Element, ...]) -> Column:
    """The first thing wrong with a record of any length: width, station, date, element, a slot; null if none."""
    day, code = _day_text(record, layout), _part(record, layout.station + len(layout.date), layout.element)
    return first_reason(
        ("width", F.char_length(record) != layout.width),
        ("station", F.trim(_part(record, 0, layout.station)) == ""),
        ("date", ~day.rlike(r"^\d{8}$") | F.try_to_timestamp(day, F.lit("yyyyMMdd")).isNull()),
        ("element", ~code.isin([e.code for e in elements])),
        ("slot", ~_slots_fine(record, code, layout, elements)),
    )


def salvage_offsets(raw: Column, layout: Layout, elements: tuple[Element, ...]) -> Column:
    """Where valid records start in an overlong line: greedy from the left, one character at a time, without overlap."""
    last = F.char_length(raw) - layout.width
    starts = F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: (k <= last) & structural_error(F.substring(raw, k + 1, F.lit(layout.width)), layout, elements).isNull())
    free = lambda taken, k: F.when((F.size(taken) == 0) | (k >= F.element_at(taken, -1) + layout.width), F.concat(taken, F.array(k))).otherwise(taken)
    return F.aggregate(starts, F.array().cast("array<int>"), free)


def route_lines(lines: DataFrame, layout: Layout, elements: tuple[Element, ...], policy: str = "error") -> tuple[DataFrame, DataFrame]:
    """(records, rejections) of lines (source, line_number, raw); a record has offset, record and its raw text."""
    if policy not in ("error", "salvage"):
        raise DeclarationError(f"unknown policy {policy!r}")
    n, w = F.char_length("raw"), layout.width
    full = F.when(n == w - 1, F.concat("raw", F.lit(" "))).when((n >= w) & (F.trim(F.substring("raw", F.lit(w + 1), n)) == ""), F.substring("raw", F.lit(1), F.lit(w)))
    # what a generator makes is computed once, however often the many expressions over slots name it
    once = lines.select("source", "line_number", F.explode(F.array("raw")).alias("raw")).filter(F.trim("raw") != "")
    seen = once.select("*", F.explode(F.array(full)).alias("full"))
    error = F.when(F.col("full").isNotNull(), structural_error(F.col("full"), layout, elements))
    if policy == "error":
        # conditions that the optimizer derives from later joins may run before the filter of blank lines
        bad = F.when(F.trim("raw") == "", F.lit(None)).when(F.col("full").isNull(), F.when(n < w, F.lit("truncated")).otherwise(F.lit("overlong"))).otherwise(error)
        checked = seen.withColumn("bad", bad)
        fine = F.when(F.col("bad").isNull(), F.col("full")).otherwise(F.raise_error(F.concat(F.lit("line "), F.col("line_number").cast("string"), F.lit(": "), F.col("bad"))).cast("string"))
        records = checked.select("source", "line_number", F.lit(0).alias("offset"), F.explode(F.array(fine)).alias("record"), "raw")
        return records, seen.filter(F.lit(False)).select(*rejection(F.col("source"), F.lit(""), F.lit(""), F.lit(""), F.col("raw"), F.lit(0), F.struct(F.lit(w).alias("expected_width"))))
    # the scan over all offsets is for malformed lines alone
    over = F.col("full").isNull() & (n > w)
    classed = seen.withColumns({"error": error, "offsets": F.when(over, salvage_offsets(F.col("raw"), layout, elements)).otherwise(F.array().cast("array<int>"))})
    fine = F.array(F.struct(F.lit(0).alias("offset"), F.col("full").alias("record"), F.col("raw").alias("raw")))
    inside = F.transform("offsets", lambda k: F.struct(k.alias("offset"), F.substring(F.col("raw"), k + 1, F.lit(w)).alias("record"), F.substring(F.col("raw"), k + 1, F.lit(w)).alias("raw")))
    kept = F.when(F.col("full").isNull(), inside).when(F.col("error").isNull(), fine)
    records = classed.select("source", "line_number", F.inline(kept))
    lost = classed.filter("full IS NULL OR error IS NOT NULL")
    found = F.size("offsets")
    reason = F.when(F.col("full").isNotNull(), "invalid_fixed_width_record").when(n < w, "truncated_fixed_width_record").when(found > 0, "extra_bytes_around_valid_fixed_width_records").otherwise("invalid_fixed_width_record")
    key = F.when(F.col("full").isNotNull(), "invalid-record").when(n < w, "truncated-record").otherwise("malformed-physical-line")
    details = F.struct(F.lit(w).alias("expected_width"), F.col("error").alias("structural_error"), F.when(over, F.col("offsets")).alias("recovered_offsets"), F.when(over, n - found * w).alias("discarded_character_count"))
    locator = F.concat(F.lit("line:"), F.col("line_number").cast("string"))
    return records, lost.select(*rejection(F.col("source"), locator, key, reason, F.col("raw"), found, details))


def _element_table(df: DataFrame, elements: tuple[Element, ...]) -> DataFrame:
    rows = [(e.code, e.variable, float(e.scale), e.duration_minutes, e.start_minute, e.end_minute, e.before_year, e.duration_minutes_before, [*e.missing]) for e in elements]
    return F.broadcast(df.sparkSession.createDataFrame(rows, "source_element string, variable string, scale double, duration int, start_minute int, end_minute int, before_year int, duration_before int, marks array<string>"))


def _slots(records: DataFrame, layout: Layout, slots: Column | None = None) -> DataFrame:
    """records with slot, text and quality_flag, a row for each of the first so many slots, all by default."""
    # code that names each slot is too long to be compiled, and a slot's place in the record is sought from its start
    cells = F.regexp_extract_all(F.substring("record", F.lit(layout.front + 1), F.lit(layout.slots * (layout.value + 1))), F.lit(rf"(?s).{{{layout.value + 1}}}"), F.lit(0))
    placed = records.select("*", F.posexplode(cells if slots is None else F.slice(cells, F.lit(1), slots)).alias("slot", "cell"))
    return placed.select("*", F.trim(F.substring("cell", F.lit(1), F.lit(layout.value))).alias("text"), F.trim(F.substring("cell", F.lit(layout.value + 1), F.lit(1))).alias("quality_flag"))


def _value(layout: Layout) -> Column:
    """The scaled number of a checked record's slot; a marker of the layout or the element gives null."""
    missing = (F.col("text") == layout.missing) | F.array_contains("marks", F.col("text"))
    return F.when(~missing, F.col("text").try_cast("double") * F.col("scale"))


def parse_hourly(lines: DataFrame, zones: DataFrame, elements: tuple[Element, ...], policy: str = "error", stations: list[str] | None = None, layout: Layout = HOURLY) -> ParseResult:
    """Hourly records in local standard time to UTC intervals, 24 a record.

    zones: (entity_id, zone), one row a station. A record of a station without zone, or of a day on which its standard
    offset changes, is set aside as a whole (policy 'salvage') or ends the job. stations limits the result.
    """
    records, lost = route_lines(lines, layout, elements, policy)
    known = records.select(
        "source", "line_number", "offset", "record", "raw", F.trim(_part(F.col("record"), 0, layout.station)).alias("entity_id"),
        F.try_to_timestamp(_day_text(F.col("record"), layout), F.lit("yyyyMMdd")).cast("date").alias("day"), _part(F.col("record"), layout.station + len(layout.date), layout.element).alias("source_element"),
    )
    known = known.filter(F.col("entity_id").isin(stations)) if stations else known
    placed = with_standard_offsets(known.join(zones.select("entity_id", "zone").filter("zone IS NOT NULL"), "entity_id", "left"), "zone", "day")
    reason = F.when(F.col("zone").isNull(), "missing_station_timezone").when(F.col("is_transition"), "standard_timezone_transition")
    placed = placed.withColumn("reason", reason)
    if policy == "error":
        stop = F.raise_error(F.concat(F.col("reason"), F.lit(" on line "), F.col("line_number").cast("string"))).cast("string")
        placed = placed.withColumn("record", F.when(F.col("reason").isNull(), F.col("record")).otherwise(stop))
        set_aside = placed.filter(F.lit(False))
    else:
        set_aside, placed = placed.filter("reason IS NOT NULL"), placed.filter("reason IS NULL")
    slots = _slots(placed.join(_element_table(lines, elements), "source_element"), layout)
    minutes = F.when(F.year("day") < F.col("before_year"), F.coalesce("duration_before", "duration")).otherwise(F.col("duration"))
    first = F.col("slot") * 60 + F.coalesce(F.col("start_minute"), F.col("end_minute") - minutes)
    start = shift_to_utc(F.timestamp_micros(F.unix_micros(F.col("day").cast("timestamp")) + first.cast("long") * 60_000_000), F.col("offset_start"))
    accepted = slots.select("entity_id", start.alias("time_start"), minutes.alias("minutes"), "variable", _value(layout).alias("value"), "quality_flag", "source_element", "source", "line_number")
    end = F.timestamp_micros(F.unix_micros("time_start") + F.col("minutes").cast("long") * 60_000_000)
    accepted = accepted.select("entity_id", "time_start", end.alias("time_end"), "variable", "value", "quality_flag", "source_element", "source", "line_number")
    locator = F.concat(F.lit("line:"), F.col("line_number").cast("string"), F.lit(":chars:"), (F.col("offset") + 1).cast("string"), F.lit("-"), (F.col("offset") + F.char_length("raw")).cast("string"))
    aside = set_aside.select(*rejection(F.col("source"), locator, F.lit("record"), F.col("reason"), F.col("raw"), F.lit(0), F.struct("entity_id", F.col("day").cast("string").alias("day"), "source_element")))
    return ParseResult(accepted, lost.unionByName(aside))


@dataclass(frozen=True)
class DayEra:
    """From `start` on, and before `end`, days close at `hour` UTC."""

    start: str
    end: str | None
    hour: int


def parse_daily(lines: DataFrame, elements: tuple[Element, ...], eras: tuple[DayEra, ...], layout: Layout = MONTHLY) -> ParseResult:
    """Monthly records to climatological days, from the era's UTC hour to the next day's; slots beyond the month drop out.

    A day that no era, or more than one, holds ends the job, as do malformed lines.
    """
    records, lost = route_lines(lines, layout, elements, "error")
    record = F.col("record")
    known = records.select("source", "line_number", "record", F.trim(_part(record, 0, layout.station)).alias("entity_id"), _part(record, layout.station, 6).alias("month"), _part(record, layout.station + 6, layout.element).alias("source_element"))
    days = days_in_month(F.substring("month", 1, 4).cast("int"), F.substring("month", 5, 2).cast("int"))
    dated = known.withColumn("first_day", F.to_date(F.concat("month", F.lit("01")), "yyyyMMdd"))
    slots = _slots(dated.join(_element_table(lines, elements), "source_element"), layout, F.least(days, F.lit(layout.slots)))
    real = slots.withColumn("day", F.date_add("first_day", F.col("slot")))
    hits, hour = F.lit(0), F.lit(None).cast("int")
    for e in eras:
        now = (F.col("day") >= F.lit(e.start).cast("date")) & (F.lit(True) if e.end is None else F.col("day") < F.lit(e.end).cast("date"))
        hits, hour = hits + F.when(now, 1).otherwise(0), F.when(now, F.lit(e.hour)).otherwise(hour)
    hour = F.when(hits == 1, hour).otherwise(F.raise_error(F.concat(F.lit("no single day boundary for "), F.col("day").cast("string"))).cast("int"))
    start = F.timestamp_micros(F.unix_micros(F.col("day").cast("timestamp")) + hour.cast("long") * 3_600_000_000)
    accepted = real.select("entity_id", start.alias("time_start"), (start + F.expr("INTERVAL '1' DAY")).alias("time_end"), "variable", _value(layout).alias("value"), "quality_flag", "source_element", "source", "line_number")
    return ParseResult(accepted, lost)


def check_zones(zones: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """(entity_id, zone): one row a station; declared overrides fill stations that have none and must agree elsewhere."""
    several = F.raise_error(F.concat(F.lit("a station with several zones: "), F.coalesce("entity_id", F.lit("none")))).cast("string")
    own = zones.filter("zone IS NOT NULL").groupBy("entity_id").agg(F.when(F.count("*") > 1, several).otherwise(F.min("zone")).alias("zone"))
    if overrides is None:
        return own
    other = overrides.select("entity_id", F.col("zone").alias("declared"))
    clash = F.raise_error(F.concat(F.lit("zones disagree for "), F.col("entity_id"))).cast("string")
    zone = F.when(F.col("zone").isNotNull() & F.col("declared").isNotNull() & (F.col("zone") != F.col("declared")), clash).otherwise(F.coalesce("zone", "declared"))
    return own.join(other, "entity_id", "full_outer").select("entity_id", zone.alias("zone"))


