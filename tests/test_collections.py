"""Jobs over pages and files: what they refuse, what they return, how often they read."""

import gzip
import hashlib
import lzma
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tideglass.operators.gates import GateError
from tideglass.plans import jobs, members, tables
from tideglass.plans.fixed_width import Element, check_elements
from tideglass.plans.pages import PageLayout, collect_pages
from tideglass.sources.lines import read_wide_parquet
from tideglass.spec import DatasetSpec, DeclarationError, VariableSpec

COLUMNS = ["STATION", "LOCAL_DATE", "KIND", "VALUE", "FLAG"]
LAYOUT = PageLayout(COLUMNS, "STATION", "LOCAL_DATE", constants=["KIND"], numbers=["VALUE"], markers={"M": ["VALUE"]}, flags=["FLAG"])
DAY = datetime(2020, 1, 1), datetime(2020, 1, 2)


def page(*rows):
    return ",".join(COLUMNS) + "\r\n" + "".join(",".join(map(str, r)) + "\r\n" for r in rows)


def collect(spark, pages, counts, layout=LAYOUT, zones=(("a", "America/Regina"), ("b", None))):
    return collect_pages(
        spark.createDataFrame([*pages], "source string, body string"), spark.createDataFrame([(s, c, *DAY, n) for s, c, n in counts], "source string, climate_id string, window_start timestamp, window_end timestamp, matched long"),
        spark.createDataFrame([*zones], "entity_id string, zone string"), layout,
    )


GOOD = [("p1", page(("a", "2020-01-01 01:00:00", "k", 1.5, ""), ("a", "2020-01-01 02:00:00", "k", "M", "E"))), ("p2", page(("a", "2020-01-01 03:00:00", "k", 2, "E"))), ("p3", page(("b", "2020-01-01 01:00:00", "k", 3, "")))]
COUNTS = [("p1", "a", 3), ("p2", "a", 3), ("p3", "b", 1)]


def test_pages(spark):
    found = collect(spark, GOOD, COUNTS)
    rows = found.result.accepted.orderBy("time_start").collect()
    assert [(r.entity_id, r.time_start, r.time_end, r.VALUE) for r in rows] == [("a", datetime(2020, 1, 1, h + 6), datetime(2020, 1, 1, h + 7), v) for h, v in ((0, 1.5), (1, None), (2, 2.0))]
    assert [(r.source, r.reason) for r in found.result.rejected.collect()] == [("p3", "missing_station_timezone")]
    assert sorted(tuple(r) for r in found.accounts.collect()) == [("p1", 2, 2, 0, "", True), ("p2", 1, 1, 0, "", True), ("p3", 1, 0, 1, "missing_station_timezone:1", True)]
    assert sorted(tuple(r) for r in found.flags.collect()) == [("p1", "FLAG", "E", 1), ("p2", "FLAG", "E", 1)]
    r = found.record.first()
    assert (r.stations, r.windows, r.pages, r.matched, r.published, r.set_aside, r.empty_windows) == (2, 2, 3, 4, 3, 1, 0)
    assert (found.metrics["rows"], found.metrics["set_aside"], found.metrics["faults"]) == (4, 1, 0)


def test_results_read_the_staged_rows(spark):
    found = collect(spark, GOOD, COUNTS)
    for df in (found.result.accepted, found.result.rejected, found.flags, found.accounts):
        shown = df._jdf.queryExecution().toString()
        assert "from_csv" not in shown and "body" not in shown and "parquet" in shown  # pages are parsed no second time


@pytest.mark.parametrize(
    "pages, counts, says",
    [
        ([("p1", page(("a", "2020-01-01 01:00:30", "k", 1, "")))], [("p1", "a", 1)], "not_a_whole_minute"),
        ([("p1", page(("b", "2020-01-01 01:00:00", "k", 1, "")))], [("p1", "a", 1)], "other_station"),
        ([("p1", page(("a", "2020-01-02 01:00:00", "k", 1, "")))], [("p1", "a", 1)], "outside_window"),
        (GOOD, [*COUNTS[:2], ("p4", "b", 1)], "page_without_count"),
        (GOOD, [("p1", "a", 4), ("p2", "a", 4), ("p3", "b", 1)], "pages and counts differ"),
        (GOOD, [*COUNTS, ("p4", "c", 2)], "pages and counts differ"),
        ([("p1", page(("a", "2020-01-01 01:00:00", "k", 1, ""), ("a", "2020-01-01 02:00:00", "other", 1, "")))], [("p1", "a", 2)], "vary"),
        ([("p1", page(("a", "2020-01-01 01:00:00", "k", "x", "")))], [("p1", "a", 1)], "no number"),
    ],
)
def test_pages_that_are_refused(spark, pages, counts, says):
    with pytest.raises(Exception, match=says):
        collect(spark, pages, counts)


@pytest.mark.parametrize("wrong", [{"numbers": ["OTHER"]}, {"markers": {"M": ["FLAG"]}}, {"parts": ["KIND"]}, {"columns": ["STATION", "STATION"]}, {"flags": ["VALUE"]}])
def test_layouts_that_make_no_sense(wrong):
    with pytest.raises(DeclarationError):
        PageLayout(**({"columns": COLUMNS, "station": "STATION", "local": "LOCAL_DATE", "numbers": ["VALUE"]} | wrong))


HEADER = ["UTC", "Local", "Value", "Approval", "Grade", "Qualifiers"]
PATTERN = r"^unit_(\d{3})_(\d{8})\.csv(?:\.xz|\.gz)?$"


def text(station, n=2):
    return f"# Station: {station}\n# Unit: m3/s\n{', '.join(HEADER)}\n" + "".join(f"2020-01-01T{k % 24:02}:00:00Z,x,{k}.5,Approved,20,A,B\r\n" for k in range(n)) + ",,,\n"


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "unit_001_20200101.csv.xz").write_bytes(lzma.compress(text("001", 5000).encode()))
    whole = text("002").encode()
    (tmp_path / "unit_002_20200101.csv.gz").write_bytes(gzip.compress(whole[:50]) + gzip.compress(whole[50:]))
    (tmp_path / "unit_003_20200101.csv").write_text(text("003"))
    (tmp_path / "notes.txt").write_text("nobody lists this")
    return tmp_path


def manifest(spark, folder, **wrong):
    rows = [(p.name, wrong.get("size", p.stat().st_size), wrong.get("sha256", hashlib.sha256(p.read_bytes()).hexdigest())) for p in sorted(folder.glob("unit_*"))]
    return spark.createDataFrame(rows, "file_name string, size_bytes long, sha256 string")


def test_members(spark, folder):
    files = members.read_files(spark, str(folder))
    areas = spark.createDataFrame([("001", 10.0), ("002", 99.0), ("003", None)], "station string, area double")
    found = members.corrected_values(files, manifest(spark, folder), PATTERN, HEADER, width=8)
    assert found.accepted.count() == 5004
    row = found.accepted.filter("entity_id = '001'").orderBy("line_number").first()
    assert (row.time_start, row.value, row.qualifiers, row.file_name, row.line_number, row.file_sha256) == (datetime(2020, 1, 1), 0.5, '["A","B"]', "unit_001_20200101.csv.xz", 4, hashlib.sha256((folder / "unit_001_20200101.csv.xz").read_bytes()).hexdigest())
    assert found.inputs.count() == 3
    small = members.corrected_values(files, manifest(spark, folder), PATTERN, HEADER, areas=areas, limit=50.0, width=8)
    assert {r.entity_id for r in small.accepted.collect()} == {"001"} and tuple(small.counts.first()) == (1, 0, 1, 1)
    assert small.fingerprint.first() != found.fingerprint.first()


@pytest.mark.parametrize("wrong, says", [({"size": 1}, "size_differs"), ({"sha256": "0" * 64}, "digest_differs"), ({"sha256": "x"}, "bad_digest")])
def test_members_not_as_listed(spark, folder, wrong, says):
    with pytest.raises(GateError, match=says):
        members.corrected_values(members.read_files(spark, str(folder)), manifest(spark, folder, **wrong), PATTERN, HEADER)


def test_members_that_are_missing_or_another_stations(spark, folder):
    listed = manifest(spark, folder)
    with pytest.raises(GateError, match="missing_file"):
        members.corrected_values(members.read_files(spark, str(folder), "*.csv*").filter("file_name NOT LIKE '%.xz'"), listed, PATTERN, HEADER)
    (folder / "unit_003_20200101.csv").write_text(text("004"))
    with pytest.raises(Exception, match="another station"):
        members.corrected_values(members.read_files(spark, str(folder)), manifest(spark, folder), PATTERN, HEADER).accepted.collect()


@pytest.mark.parametrize("name, pack", [("f.xz", lzma.compress), ("f.gz", gzip.compress)])
def test_streams(name, pack):
    whole = b"".join(b"line %d %s\r\n" % (k, b"x" * (k % 300)) for k in range(20_000))
    assert [*members._lines(name, pack(whole))] == whole.decode().replace("\r\n", "\n").encode().split(b"\n")[:-1]
    assert b"".join(members._decoded(name, pack(whole[:9]) + pack(whole[9:]))) == whole
    assert max(map(len, members._decoded(name, pack(bytes(30 << 20))))) <= 1 << 20  # a bomb comes in pieces
    with pytest.raises(ValueError, match="ends within"):
        [*members._lines(name, pack(whole)[:-20])]
    with pytest.raises(ValueError, match="ends within"):
        [*members._lines(name, b"")]


def test_windows(spark):
    frame = lambda *rows: spark.createDataFrame([*rows], "entity_id string, start timestamp, end timestamp")
    t = datetime
    found = tables.page_windows(frame(("a", t(2019, 6, 1), t(2021, 1, 1)), ("a", t(2019, 6, 1), t(2021, 1, 1)))).orderBy("window_start").collect()
    assert [tuple(r) for r in found] == [("a", t(2019, 6, 1), t(2020, 1, 1)), ("a", t(2020, 1, 1), t(2021, 1, 1))]
    for bad, says in ((("a", t(2019, 6, 1, 0, 30), t(2020, 1, 1)), "whole_hour"), ((" ", t(2019, 6, 1), t(2020, 1, 1)), "no_id"), (("a", t(2020, 1, 1), t(2020, 1, 1)), "not_behind")):
        with pytest.raises(Exception, match=says):
            tables.page_windows(frame(bad)).collect()


def test_station_ids_have_one_type(spark):
    with pytest.raises(DeclarationError, match="station ids"):
        tables.select_members(spark.createDataFrame([("1",)], "station string"), spark.createDataFrame([(1, 2.0)], "station long, area double"), "station", 1.0)


def test_fingerprint_depth(spark):
    df = spark.range(5000).withColumn("x", F.col("id") % 7)
    one = lambda d, **k: tables.selection_fingerprint(d, ["id", "x"], {}, **k).first()[0]
    assert one(df) == one(df.repartition(7)) != one(df.filter("id > 0")) and one(df, most=1) == one(df.orderBy(F.desc("id")), most=1) != one(df)
    assert one(df) != one(df.unionByName(df.limit(1)))


def test_element_checks():
    spec = DatasetSpec("d", variables=(VariableSpec("rain", "mm"), VariableSpec("snow", "cm")))
    rain, snow = Element("123", "rain", 0.1, start_minute=0), Element("124", "snow", 0.1, start_minute=0)
    check_elements((rain, snow), spec)
    for wrong in ((rain,), (rain, snow, Element("125", "hail", 1, start_minute=0)), (rain, snow, rain), (rain, Element("124", "snow", 0.1, start_minute=0, missing=(" ",)))):
        with pytest.raises(DeclarationError):
            check_elements(wrong, spec)


def test_jobs(spark, tmp_path):
    assert jobs.job("grid") is tables.parse_grid
    with pytest.raises(DeclarationError, match="wide_table"):
        jobs.job("other")
    spec = DatasetSpec("wide", storage="wide", timezone="UTC", variables=(VariableSpec("power", "kW"),))
    source = spark.createDataFrame([("01", datetime(2024, 1, 1), "1.5")], "id string, at timestamp, p string")
    assert jobs.run_job("wide_table", spec, source, spec, "id", "at", {"power": "p"}).accepted.first().power == 1.5
    own = lambda df: df.selectExpr("id AS entity_id", "at AS time_start", "at + INTERVAL 1 HOUR AS time_end", "double(p) AS power")
    assert jobs.run_job(own, spec, source).rejected.count() == 0
    with pytest.raises(GateError, match="undeclared"):
        jobs.run_job(lambda df: df, spec, source)
    source.write.parquet(str(tmp_path / "t"))
    assert read_wide_parquet(spark, str(tmp_path / "t"), ["id", "p"], "id").columns == ["id", "p"]
    with pytest.raises(ValueError, match="text"):
        read_wide_parquet(spark, str(tmp_path / "t"), ["id", "at"], "at")
