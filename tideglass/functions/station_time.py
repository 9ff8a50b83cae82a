"""Station clocks: civil time of a zone, and local standard time, which keeps a zone's standard offset all year.

A zone's rules are looked up once for each year that rows fall into, as a short list of periods with one offset each;
rows find their period by their day. Civil clocks are resolved against a table of the zone's periods, or, for one zone,
against the offsets in force around them.
"""

from __future__ import annotations

from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HOUR = timedelta(hours=1)
_MONTHS = 120


def _standard_seconds(local: datetime, zone) -> int:
    """The standard offset in force at a wall clock.

    It is the offset less the daylight saving of up to an hour. Where more than that is called daylight saving, the
    nearest month without any decides, looked up at noon of its 15th, the earlier of two first.
    """
    there = local.replace(tzinfo=zone)
    shift, saving = there.utcoffset(), there.dst() or timedelta(0)
    if abs(saving) <= _HOUR:
        return int((shift - saving).total_seconds())
    month = local.year * 12 + local.month - 1
    for away in range(1, _MONTHS + 1):
        for m in (month - away, month + away):
            if 12 <= m < 12 * 9999:
                probe = datetime(m // 12, m % 12 + 1, 15, 12, tzinfo=zone)
                if not probe.dst():
                    return int(probe.utcoffset().total_seconds())
    raise ValueError(f"no standard offset within {_MONTHS} months of {local} in {zone}")


def _zone(name: str):
    from zoneinfo import ZoneInfo

    return ZoneInfo(name)


def standard_periods(years: DataFrame) -> DataFrame:
    """(zone, year, periods) for distinct (zone, year): array of (since, seconds), the standard offset at midnight from a day on.

    The first period begins on 1 January, the last may begin on 1 January of the next year.
    """

    def run(frames):
        for f in frames:
            made = []
            for name, year in zip(f["zone"], f["year"], strict=True):
                zone, day, periods = _zone(name), datetime(year, 1, 1), []
                while day.year == year or day.timetuple().tm_yday == 1 and day.year == year + 1:
                    seconds = _standard_seconds(day, zone)
                    if not periods or periods[-1]["seconds"] != seconds:
                        periods.append({"since": day.date(), "seconds": seconds})
                    if day.year > year or day.year == 9999 and day.timetuple().tm_yday == 365:
                        break
                    day += timedelta(days=1)
                made.append(periods)
            yield pd.DataFrame({"zone": f["zone"], "year": f["year"], "periods": made})

    asked = years.select("zone", F.col("year").cast("int")).where("zone IS NOT NULL AND year IS NOT NULL").distinct()
    return asked.mapInPandas(run, "zone string, year int, periods array<struct<since: date, seconds: int>>")


def with_standard_offsets(rows: DataFrame, zone: str, day: str) -> DataFrame:
    """rows with offset_start, offset_end and is_transition of their zone and day; nulls where either is null.

    offset_start holds at the day's first midnight, offset_end at its last, in seconds east.
    """
    years = rows.select(F.col(zone).alias("zone"), F.year(day).alias("year"))
    found = standard_periods(years).withColumnsRenamed({"zone": "_zone", "year": "_year"})
    own = rows.join(found, (F.col(zone) == F.col("_zone")) & (F.year(day) == F.col("_year")), "left")
    at = lambda d: F.element_at(F.filter("periods", lambda p: p["since"] <= d), -1)["seconds"]
    start, end = at(F.col(day)), at(F.date_add(day, 1))
    return own.withColumns({"offset_start": F.when(F.col("periods").isNotNull(), start), "offset_end": F.when(F.col("periods").isNotNull(), end)}).withColumn("is_transition", F.col("offset_start") != F.col("offset_end")).drop("_zone", "_year", "periods")


def standard_offsets(pairs: DataFrame) -> DataFrame:
    """(zone, day, offset_start, offset_end, is_transition) for the distinct (zone, day) of pairs; offsets are seconds east."""
    return with_standard_offsets(pairs.select("zone", "day").where("zone IS NOT NULL AND day IS NOT NULL").distinct(), "zone", "day")


def shift_to_utc(local: Column, seconds: Column) -> Column:
    """A wall clock at so many seconds east, as an instant (in a session that runs on UTC)."""
    return F.timestamp_micros(F.unix_micros(local) - seconds.cast("long") * 1_000_000)


def instant_offset(local: Column, offset_start: Column, offset_end: Column, at_end: Column) -> Column:
    """The offset of a clock: the next day's where the clock stands at the day's end."""
    return F.when(at_end, offset_end).otherwise(offset_start)


# civil time

#: Hours around a wall clock, read as UTC, at which offsets are looked up: no offset is farther from UTC.
_AROUND = (-28, -14, 14, 28)


def _seconds_in_force(instant: Column, zone: Column | str) -> Column:
    """A zone's offset at an instant, in seconds east."""
    return F.unix_seconds(F.from_utc_timestamp(instant, zone)) - F.unix_seconds(instant)


def civil_instants(local: Column, zone: Column | str) -> Column:
    """The instants at which a zone's wall clocks show `local`, in order: none in a gap, two where clocks were set back.

    A clock that shows `local` is some offset in force around it away from `local` read as UTC; each of those few is
    tried. That holds for shifts of any size.
    """
    tried = F.array_distinct(F.array(*(shift_to_utc(local, _seconds_in_force(local + F.expr(f"INTERVAL '{h}' HOUR"), zone)) for h in _AROUND)))
    return F.array_sort(F.filter(tried, lambda u: F.from_utc_timestamp(u, zone) == local))


def civil_to_utc(local: Column, zone: str) -> Column:
    """A wall clock of a zone as an instant; clocks that occur twice or never end the job.

    Where the offset is the same over a day before and behind, which is nearly always, it is the clock's own.
    """
    # plain sums of microseconds: Spark takes an interval of hours through the session's calendar
    around = lambda h: _seconds_in_force(shift_to_utc(local, F.lit(-3600 * h)), zone)
    first = around(_AROUND[0])
    alone = shift_to_utc(local, first)
    steady = (first == around(_AROUND[-1])) & (F.from_utc_timestamp(alone, zone) == local)
    found = civil_instants(local, zone)
    fault = lambda what: F.raise_error(F.concat(F.lit(f"{what} in {zone}: "), local.cast("string"))).cast("timestamp")
    resolved = F.when(F.size(found) == 0, fault("no such local time")).when(F.size(found) > 1, fault("ambiguous local time")).otherwise(F.get(found, F.lit(0)))
    return F.when(local.isNull(), F.lit(None).cast("timestamp")).when(steady, alone).otherwise(resolved)


def zone_periods(zones: DataFrame, first: str, last: str) -> DataFrame:
    """(zone, since, until, seconds, local_since, local_until): the periods of one offset of distinct zones between two dates.

    Offsets are compared at the ends of each quarter of a day; only where they differ the hours, minutes and seconds of
    it are. All of it runs in the JVM. The first period begins before the first date, the last has no end.
    """
    named = zones.select("zone").where("zone IS NOT NULL").distinct()
    begin = F.lit(first).cast("timestamp")
    quarters = F.explode(F.sequence(begin, F.lit(last).cast("timestamp"), F.expr("INTERVAL '6' HOUR")))
    found, width = named.select("zone", quarters.alias("at")), 6 * 3600
    later = lambda seconds: shift_to_utc(F.col("at"), F.lit(-seconds))
    differs = lambda df, width: df.filter(_seconds_in_force(F.col("at"), F.col("zone")) != _seconds_in_force(later(width), F.col("zone")))
    for n in (6, 60, 60):
        finer = width // n
        found = differs(found, width).select("zone", F.col("at").alias("_at"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_k")).select("zone", shift_to_utc(F.col("_at"), F.col("_k") * F.lit(-finer)).alias("at"))
        width = finer
    turns = differs(found, width).select("zone", later(width).alias("since"))
    starts = turns.unionByName(named.select("zone", F.lit(None).cast("timestamp").alias("since")))
    order = Window.partitionBy("zone").orderBy("since")  # a zone's transitions
    rows = starts.select("zone", "since", F.lead("since").over(order).alias("until"), _seconds_in_force(F.coalesce("since", begin), F.col("zone")).cast("int").alias("seconds"))
    local = lambda c: shift_to_utc(F.col(c), -F.col("seconds"))
    return rows.select("*", local("since").alias("local_since"), local("until").alias("local_until"))


def with_civil_instants(rows: DataFrame, zone: str, local: str, first: str, last: str) -> DataFrame:
    """rows with instant and fault: the instant at which the zone's wall clocks show `local`, between two dates.

    fault is no_such_local_time, ambiguous_local_time, outside_known_years or null; rows without zone or clock have
    neither, and a zone that nobody knows ends the job. The periods of all zones are dealt to the calendar years that they touch, so a row meets the few of its own.
    """
    low, high = int(first[:4]), int(last[:4])
    year = lambda c, other: F.coalesce(F.year(c), F.lit(other))
    lived = zone_periods(rows.select(F.col(zone).alias("zone")), f"{low}-01-01", f"{high + 1}-01-01")
    span = F.explode(F.sequence(F.greatest(year("local_since", low), F.lit(low)), F.least(year("local_until", high), F.lit(high))))
    lived = lived.filter((year("local_since", low) <= high) & (year("local_until", high) >= low)).withColumn("_year", span)
    by_year = lived.groupBy(F.col("zone").alias("_zone"), "_year").agg(F.collect_list(F.struct("local_since", "local_until", "seconds")).alias("_periods"))  # a year's periods
    own = rows.join(by_year, (F.col(zone) == F.col("_zone")) & (F.year(local) == F.col("_year")), "left")
    at = F.col(local)
    holds = lambda p: (p["local_since"].isNull() | (at >= p["local_since"])) & (p["local_until"].isNull() | (at < p["local_until"]))
    hits = F.filter("_periods", holds)
    known = F.col(zone).isNotNull() & at.isNotNull()
    fault = F.when(known, F.when(F.col("_periods").isNull(), "outside_known_years").when(F.size(hits) == 0, "no_such_local_time").when(F.size(hits) > 1, "ambiguous_local_time"))
    instant = F.when(known & (F.size(hits) == 1), shift_to_utc(at, F.get(hits, F.lit(0))["seconds"]))
    return own.withColumns({"instant": instant, "fault": fault}).drop("_zone", "_year", "_periods")
