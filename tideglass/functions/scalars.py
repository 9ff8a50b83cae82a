"""Scalar functions on columns: numbers and identifiers as publishers write them, calendars, markers, buckets."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideglass.spec import SentinelRule

#: What counts as a number: no words, no underscores, no type suffixes.
NUMBER = r"^[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?$"


def is_number(text: Column) -> Column:
    return F.coalesce(text.rlike(NUMBER), F.lit(False))


def parse_number(text: Column) -> Column:
    """The number that a trimmed field spells; null where it spells none. A field must be guarded before its cast."""
    trimmed = F.trim(text)
    return F.when(is_number(trimmed), trimmed.cast("double"))


def strict_number(text: Column, name: str) -> Column:
    """As parse_number, but a non-null field that spells no number ends the job."""
    found = parse_number(text)
    return F.when(text.isNull() | found.isNotNull(), found).otherwise(F.raise_error(F.concat(F.lit(f"{name}: no number: "), text)).cast("double"))


def scaled(value: Column, scale: float) -> Column:
    return value * F.lit(float(scale))


def whole_within(text: Column, least: int, most: int) -> Column:
    """Whether a field is an integer within [least, most]."""
    fits = text.rlike(r"^[+-]?\d{1,9}$")
    return F.coalesce(F.when(fits, text.cast("int").between(least, most)), F.lit(False))


def clean_identifier(text: Column) -> Column:
    """Trimmed, without the .0 of a whole number; blank gives null."""
    bare = F.trim(F.regexp_replace(F.trim(text.cast("string")), r"^(-?\d+)\.0+$", "$1"))
    return F.when(bare != "", bare)


def signed_longitude(value: Column, convention: str) -> Column:
    """Degrees east in [-180, 180) or as given; what lies outside [-180, 180] then ends the job.

    '0_360' wraps any number of turns; 'signed' takes the value as it is.
    """
    if convention == "0_360":
        out = F.pmod(value + 180.0, F.lit(360.0)) - 180.0
    elif convention == "signed":
        out = value
    else:
        raise ValueError(f"unknown longitude convention {convention!r}")
    return F.when(value.isNull() | out.between(-180, 180), out).otherwise(F.raise_error(F.concat(F.lit("longitude out of range: "), value.cast("string"))).cast("double"))


def days_in_month(year: Column, month: Column) -> Column:
    """28 to 31; an impossible month ends the job."""
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    short = F.when(month.isin(4, 6, 9, 11), 30).when(month == 2, F.when(leap, 29).otherwise(28)).otherwise(31)
    return F.when(month.between(1, 12) & year.between(1, 9999), short).otherwise(F.raise_error(F.lit("impossible year or month")).cast("int"))


def is_calendar_day(year: Column, month: Column, day: Column) -> Column:
    return day.between(F.lit(1), days_in_month(year, month))


def entity_bucket(entity: Column, buckets: int) -> Column:
    """A stable bucket of an id: the same in any engine that has MD5."""
    return (F.conv(F.substring(F.md5(entity.cast("binary")), 1, 15), 16, 10).cast("long") % buckets).cast("int")


def raw_digest(raw: Column) -> Column:
    return F.sha2(raw.cast("binary"), 256)


def manifest_row_id(snapshot_id: Column, key: Column) -> Column:
    return F.concat(F.lit("frag_"), F.md5(F.concat_ws("\u001f", snapshot_id, key).cast("binary")))


def same_coordinate(a: Column, b: Column) -> Column:
    """Within 1e-9; what spells no number is never the same."""
    return F.coalesce(F.abs(parse_number(a) - parse_number(b)) <= 1e-9, F.lit(False))


def qualifiers_json(cells: Column, first: int) -> Column:
    """The non-blank cells from position `first` (0-based) on, in order, as a JSON array."""
    rest = F.when(F.size(cells) > first, F.slice(cells, first + 1, F.size(cells) - first)).otherwise(F.array().cast("array<string>"))
    return F.to_json(F.filter(rest, lambda x: F.trim(x) != ""))


def utc_instant(text: Column) -> Column:
    """An ISO-8601 instant that ends in Z; null where the text is none."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"), F.try_to_timestamp(F.regexp_replace(text, "[TZ]", " "), F.lit("yyyy-MM-dd HH:mm:ss ")))


def slot_interval(label: Column, slot: str, duration: str) -> tuple[Column, Column]:
    """(start, end) of the interval that a label begins ('start') or ends ('end'); duration as in '10 minutes'."""
    span = F.expr(f"INTERVAL {duration}")
    if slot == "start":
        return label, label + span
    if slot == "end":
        return label - span, label
    raise ValueError(f"a label stands at start or end, not {slot!r}")


def apply_sentinels(raw: Column, at: Column, rules: tuple[SentinelRule, ...]) -> Column:
    """A field's number, or what the one rule makes of it whose marker it is and whose era holds at `at`.

    Markers are compared as written. A marker outside all its eras, and eras of one marker that overlap, end the job.
    """
    stamp = lambda t: F.lit(t.isoformat(sep=" ") if isinstance(t, datetime) else t).cast("timestamp")
    hits, value, markers = F.lit(0), F.lit(None).cast("double"), sorted({r.marker for r in rules})
    for r in rules:
        now = raw == r.marker
        if r.start is not None:
            now = now & (at >= stamp(r.start))
        if r.end is not None:
            now = now & (at < stamp(r.end))
        hits = hits + F.when(now, 1).otherwise(0)
        value = F.when(now, F.lit(r.value).cast("double")).otherwise(value)
    fault = lambda what: F.raise_error(F.concat(F.lit(f"{what}: "), raw)).cast("double")
    known = raw.isin(markers) if markers else F.lit(False)
    return F.when(hits == 1, value).when(hits > 1, fault("eras overlap for marker")).when(known, fault("no era for marker")).otherwise(strict_number(raw, "value"))


def request_bound(value: str | datetime | None) -> datetime | None:
    """A bound of a request: naive means UTC, '2015' is 1 January."""
    if value is None or isinstance(value, datetime):
        return value
    text = value.strip()
    for pattern in ("%Y", "%Y-%m", "%Y-%m-%d", "%Y-%m-%dT%H:%M", "%Y-%m-%d %H:%M", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S"):
        try:
            return datetime.strptime(text, pattern)
        except ValueError:
            continue
    return datetime.fromisoformat(text)
