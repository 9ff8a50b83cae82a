"""Parse jobs on small archives with known results."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tideglass.operators.analysis import merged_spans, uncovered
from tideglass.plans import fixed_width as W
from tideglass.plans import tables
from tideglass.sources import lines as L

RAIN = (W.Element("123", "rain", 0.1, 60, start_minute=0), W.Element("264", "quarter", 0.1, 15, start_minute=15), W.Element("267", "five", 0.1, 5, end_minute=15))


def record(station="702S006", day="20140801", element="123", values=(27, None, *[0] * 22)):
    return f"{station:>7}{day}{element}" + "".join((f"{-99999 if v is None else v:6d}" + ("M" if v is None else " ")) for v in values)


def lines(spark, *raw):
    return spark.createDataFrame([("f", k + 1, r) for k, r in enumerate(raw)], "source string, line_number long, raw string")


def zones(spark, *pairs):
    return spark.createDataFrame([*pairs], "entity_id string, zone string")


def test_hourly(spark):
    parsed = W.parse_hourly(lines(spark, record()[:-1], "   "), zones(spark, ("702S006", "America/Toronto")), RAIN)
    rows = parsed.accepted.orderBy("time_start").collect()
    assert len(rows) == 24 and rows[0].value == pytest.approx(2.7) and rows[1].value is None and rows[1].quality_flag == "M" and rows[2].value == 0
    assert rows[0].time_start == datetime(2014, 8, 1, 5) and rows[0].time_end == datetime(2014, 8, 1, 6)


def test_placement(spark):
    z = zones(spark, ("702S006", "America/Toronto"))
    spans = {e: W.parse_hourly(lines(spark, record(day="20190101", element=e)), z, RAIN).accepted.agg(F.min("time_start"), F.min("time_end")).first() for e in ("264", "267")}
    assert tuple(spans["264"]) == (datetime(2019, 1, 1, 5, 15), datetime(2019, 1, 1, 5, 30))
    assert tuple(spans["267"]) == (datetime(2019, 1, 1, 5, 10), datetime(2019, 1, 1, 5, 15))


def test_salvage(spark):
    parsed = W.parse_hourly(lines(spark, record() + "PUBLISHER-GARBAGE", "truncated", "X" * 186, "?" + record() + record(day="20140802") + "!"), zones(spark, ("702S006", "America/Toronto")), RAIN, "salvage")
    assert parsed.accepted.count() == 72
    reasons = {r.line: (r.reason, r.recovered_count) for r in parsed.rejected.withColumn("line", F.regexp_extract("record_locator", r"line:(\d+)", 1).cast("int")).collect()}
    assert reasons == {1: ("extra_bytes_around_valid_fixed_width_records", 1), 2: ("truncated_fixed_width_record", 0), 3: ("invalid_fixed_width_record", 0), 4: ("extra_bytes_around_valid_fixed_width_records", 2)}


def test_strict_and_quarantine(spark):
    z = zones(spark, ("702S006", "America/Dawson"))
    with pytest.raises(Exception, match="overlong"):
        W.parse_hourly(lines(spark, record() + "garbage"), z, RAIN).accepted.collect()
    parsed = W.parse_hourly(lines(spark, record(day="20201031"), record(station="9052008"), record(day="20201101")), z, RAIN, "salvage")
    assert parsed.accepted.count() == 24
    assert sorted((r.record_locator, r.reason) for r in parsed.rejected.collect()) == [("line:1:chars:1-186", "standard_timezone_transition"), ("line:2:chars:1-186", "missing_station_timezone")]


def test_overrides(spark):
    own, other = zones(spark, ("a", "America/Toronto"), ("b", None)), zones(spark, ("b", "America/Regina"), ("a", "America/Toronto"))
    assert {(r.entity_id, r.zone) for r in W.check_zones(own, other).collect()} == {("a", "America/Toronto"), ("b", "America/Regina")}
    with pytest.raises(Exception, match="disagree"):
        W.check_zones(own, zones(spark, ("a", "America/Regina"))).collect()


def test_daily(spark):
    raw = "6153193201402001" + "".join(f"{v:6d} " for v in [231, -99999] + [0] * 29)
    eras = (W.DayEra("1961-07-01", None, 6),)
    rows = W.parse_daily(lines(spark, raw), (W.Element("001", "temperature", 0.1, start_minute=0),), eras).accepted.orderBy("time_start").collect()
    assert len(rows) == 28 and rows[0].value == pytest.approx(23.1) and rows[1].value is None and rows[0].time_start == datetime(2014, 2, 1, 6)
    with pytest.raises(Exception, match="no single day boundary"):
        W.parse_daily(lines(spark, raw.replace("201402", "196001")), (W.Element("001", "temperature", 0.1, start_minute=0),), eras).accepted.collect()


def test_line_numbers(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\r\n\ntwo\n" + "x\n" * 500)
    (tmp_path / "b.txt").write_text("first\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        found = {(r.source.rsplit("/", 1)[-1], r.line_number): r.raw for r in L.read_lines(spark, str(tmp_path), "*.txt").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(found) == 504 and found["a.txt", 1] == "one" and found["a.txt", 2] == "" and found["a.txt", 3] == "two" and found["b.txt", 1] == "first" and ("a.txt", 503) in found


def test_commented_csv(spark):
    text = "# Station: 01AB\n# Unit: m3/s\nUTC, Local, Value\n2020-01-01T00:00:00Z,x,0.01\n,,\n2020-01-01T00:05:00Z,x,0.02,A, ,B\n"
    rows = L.commented_csv(L.lines_of(spark.createDataFrame([("f", text)], "source string, text string"), "source", "text"), ["UTC", "Local", "Value"], ["Station", "Unit"], 8)
    assert [r.cells for r in rows.orderBy("line_number").collect()] == [["2020-01-01T00:00:00Z", "x", "0.01"], ["2020-01-01T00:05:00Z", "x", "0.02", "A", " ", "B"]]
    with pytest.raises(Exception, match="not as declared"):
        L.commented_csv(L.lines_of(spark.createDataFrame([("f", text.replace("# Unit", "# Other"))], "source string, text string"), "source", "text"), ["UTC", "Local", "Value"], ["Station", "Unit"], 8).collect()


@pytest.mark.parametrize("bad", ["A,B\r\n1,2", "A,C\r\n1,2\r\n"])
def test_api_pages_fail_closed(spark, bad):
    pages = spark.createDataFrame([("p", bad)], "source string, body string")
    with pytest.raises(Exception, match="header|line end"):
        L.api_pages(pages, ["A", "B"]).collect()


def test_hits(spark):
    body = lambda n: F.lit('{"type":"FeatureCollection","features":[],"numberMatched":%s}' % n)
    assert spark.range(1).select(L.hits_count(body("744"))).first()[0] == 744
    for n in ("true", "-1", "null"):
        with pytest.raises(Exception, match="no valid count"):
            spark.range(1).select(L.hits_count(body(n))).collect()


def test_page_checks(spark):
    row = lambda local, station="a": ("p", 1, "a", station, local, datetime(2020, 1, 1), datetime(2020, 1, 2))
    rows = [row("2020-01-01 00:00:00"), row("2020-01-01 01:00:00"), row("2020-01-01 01:00:00"), row("2020-01-03 00:00:00"), row("2020-01-01 02:00:30"), row("x"), row("2020-01-01 05:00:00", "b")]
    df = spark.createDataFrame(rows, "source string, row_number int, climate_id string, station_id string, local_date string, window_start timestamp, window_end timestamp")
    assert sorted(str(r.fault) for r in tables.check_page_rows(df).collect()) == ["None", "not_a_whole_minute", "other_station", "outside_window", "repeated_hour", "repeated_hour", "unreadable_date"]


def test_shrinking_selection(spark):
    t = lambda h: datetime(2020, 1, 1, h)
    spans = "s string, start timestamp, end timestamp"
    published = spark.createDataFrame([("a", t(1), t(5))], spans)
    assert uncovered(published, spark.createDataFrame([("a", t(1), t(3)), ("a", t(3), t(6))], spans), "s").count() == 0
    assert uncovered(published, spark.createDataFrame([("a", t(2), t(6))], spans), "s").count() == 1
    assert merged_spans(spark.createDataFrame([("a", t(1), t(2)), ("a", t(2), t(3)), ("a", t(5), t(6))], spans), "s", "start", "end").count() == 2


def test_wide_and_inventory(spark):
    from tideglass.spec import DatasetSpec, VariableSpec

    spec = DatasetSpec("wide", storage="wide", timezone="America/Toronto", variables=(VariableSpec("power", "kW", quality_field="power_quality"),))
    table = spark.createDataFrame([("01", datetime(2024, 1, 1, 0, 10), "10.5", "ok")], "id string, at timestamp, p string, q string")
    row = tables.parse_wide(table, spec, "id", "at", {"power": "p", "power_quality": "q"}, "end").accepted.first()
    assert (row.entity_id, row.time_start, row.time_end, row.power, row.power_quality) == ("01", datetime(2024, 1, 1, 5), datetime(2024, 1, 1, 5, 10), 10.5, "ok")
    with pytest.raises(ValueError):
        tables.parse_wide(table, spec, "id", "at", {"power": "p"}, "end")
    found = tables.parse_inventory(spark.createDataFrame([("6153193.0", "350")], "a string, b string"), {"entity_id": "a", "longitude": "b"}, ["longitude"], "longitude", "0_360").first()
    assert (found.entity_id, found.longitude) == ("6153193", -10)
