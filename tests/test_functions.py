"""Scalars, markers and clocks on small fixtures with known results."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tideglass.functions import scalars as S
from tideglass.functions.station_time import civil_to_utc, standard_offsets, with_civil_instants, zone_periods
from tideglass.spec import SentinelRule


def one(spark, column):
    return spark.range(1).select(column.alias("x")).collect()[0][0]


@pytest.mark.parametrize("text, number", [("12.5", 12.5), (" -3 ", -3.0), ("1d", None), ("nan", None), ("1_0", None), ("", None), (".5e1", 5.0), (None, None)])
def test_numbers(spark, text, number):
    assert one(spark, S.parse_number(F.lit(text).cast("string"))) == number


@pytest.mark.parametrize("text, cleaned", [("6153193.0", "6153193"), (" 10114F6 ", "10114F6"), ("  ", None), (None, None), ("1.50", "1.50")])
def test_identifiers(spark, text, cleaned):
    assert one(spark, S.clean_identifier(F.lit(text).cast("string"))) == cleaned


def test_longitudes(spark):
    assert one(spark, S.signed_longitude(F.lit(350.0), "0_360")) == -10
    assert one(spark, S.signed_longitude(F.lit(-79.9), "signed")) == -79.9
    with pytest.raises(ValueError):
        S.signed_longitude(F.lit(1.0), "other")
    assert one(spark, S.signed_longitude(F.lit(370.0), "0_360")) == 10 and one(spark, S.signed_longitude(F.lit(180.0), "0_360")) == -180
    with pytest.raises(Exception, match="out of range"):
        one(spark, S.signed_longitude(F.lit(400.0), "signed"))


def test_calendar(spark):
    days = lambda y, m, d: one(spark, S.is_calendar_day(F.lit(y), F.lit(m), F.lit(d)))
    assert days(2024, 2, 29) and not days(2023, 2, 29) and not days(2024, 2, 30)
    with pytest.raises(Exception, match="impossible"):
        days(2024, 13, 1)


def test_sentinels(spark):
    turn = datetime(2020, 1, 1)
    rules = (SentinelRule("-9999.9", "missing", None, turn), SentinelRule("-9999.9", "measured_zero", turn, None), SentinelRule("-9", "missing", datetime(1990, 1, 1), datetime(1991, 1, 1)))
    at = lambda raw, t: one(spark, S.apply_sentinels(F.lit(raw), F.lit(t).cast("timestamp"), rules))
    assert at("-9999.9", "2019-12-31 23:00:00") is None
    assert at("-9999.9", "2020-01-01 00:00:00") == 0.0
    assert at("12.5", "2020-01-01 00:00:00") == 12.5
    with pytest.raises(Exception, match="no era"):
        at("-9", "2020-01-01 00:00:00")
    both = (SentinelRule("x"), SentinelRule("x", "measured_zero"))
    with pytest.raises(Exception, match="overlap"):
        one(spark, S.apply_sentinels(F.lit("x"), F.lit("2020-01-01").cast("timestamp"), both))


def test_civil_time(spark):
    at = lambda t: one(spark, F.date_format(civil_to_utc(F.lit(t).cast("timestamp"), "America/Toronto"), "yyyy-MM-dd HH:mm"))
    assert at("2024-07-01 00:00:00") == "2024-07-01 04:00"
    with pytest.raises(Exception, match="ambiguous"):
        at("2024-11-03 01:30:00")
    with pytest.raises(Exception, match="no such"):
        at("2024-03-10 02:30:00")


@pytest.mark.parametrize("zone, local, fault", [("Antarctica/Troll", "2023-10-29 01:30:00", "ambiguous"), ("Antarctica/Troll", "2023-03-26 02:30:00", "no such"), ("Australia/Lord_Howe", "2023-04-02 01:45:00", "ambiguous"), ("Australia/Lord_Howe", "2023-10-01 02:15:00", "no such"), ("Pacific/Apia", "2011-12-30 10:00:00", "no such")])
def test_civil_time_of_any_shift(spark, zone, local, fault):
    with pytest.raises(Exception, match=fault):
        one(spark, civil_to_utc(F.lit(local).cast("timestamp"), zone))
    rows = spark.createDataFrame([(zone, local), (zone, "2023-07-01 02:30:00"), (None, local), (zone, None), (zone, "1999-01-01 00:00:00")], "zone string, local string").withColumn("local", F.col("local").cast("timestamp"))
    found = [(r.instant, r.fault) for r in with_civil_instants(rows, "zone", "local", "2010", "2024").orderBy(F.col("local").isNull(), F.col("zone").isNull(), "local").collect()]
    assert found[0] == (None, "outside_known_years") and sorted(str(f[1]) for f in found[1:]) == sorted(["None", "None", "None", "ambiguous_local_time" if fault == "ambiguous" else "no_such_local_time"])


def test_periods_equal_the_zone_rules(spark):
    from datetime import timedelta, timezone
    from zoneinfo import ZoneInfo

    names = ["America/Toronto", "Antarctica/Troll", "Australia/Lord_Howe", "Asia/Kathmandu", "Pacific/Apia", "UTC"]
    periods = zone_periods(spark.createDataFrame([(n,) for n in [*names, "UTC"]] + [(None,)], "zone string"), "2009-01-01", "2014-01-01").collect()
    for name in names:
        own = sorted((p for p in periods if p.zone == name), key=lambda p: (p.since is not None, p.since))
        at = datetime(2009, 1, 2)
        while at < datetime(2014, 1, 1):
            [now] = [p for p in own if (p.since is None or p.since <= at) and (p.until is None or at < p.until)]
            assert at.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(name)).utcoffset().total_seconds() == now.seconds
            at += timedelta(hours=7)


def test_standard_offsets(spark):
    rows = [("America/Toronto", date(2018, 7, 1)), ("America/Toronto", date(1943, 1, 1)), ("America/Dawson", date(2020, 10, 31)), ("America/Dawson", date(2020, 7, 1)), ("America/Inuvik", date(2004, 10, 31)), (None, date(2020, 1, 1))]
    found = {(r.zone, r.day): (r.offset_start // 3600, r.offset_end // 3600, r.is_transition) for r in standard_offsets(spark.createDataFrame(rows, "zone string, day date")).collect()}
    assert found["America/Toronto", date(2018, 7, 1)] == (-5, -5, False)
    assert found["America/Toronto", date(1943, 1, 1)] == (-5, -5, False)
    assert found["America/Dawson", date(2020, 10, 31)] == (-8, -7, True)
    assert found["America/Dawson", date(2020, 7, 1)] == (-8, -8, False)
    assert found["America/Inuvik", date(2004, 10, 31)] == (-7, -7, False)
    assert len(found) == 5


def test_request_bounds():
    assert S.request_bound("2015") == datetime(2015, 1, 1)
    assert S.request_bound("2015-02-03T04:05") == datetime(2015, 2, 3, 4, 5)
    assert S.request_bound(None) is None


def test_qualifiers(spark):
    cells = F.array(*map(F.lit, ["t", "v", "A", " ", "B"]))
    assert one(spark, S.qualifiers_json(cells, 2)) == '["A","B"]'
    assert one(spark, S.qualifiers_json(cells, 5)) == "[]"
