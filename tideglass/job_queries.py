"""Registered queries over whole jobs: pages with their gates, archives read back from files, runs and their records."""

from __future__ import annotations

import gzip
import lzma

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideglass import recast
from tideglass.functions import scalars as S
from tideglass.functions.station_time import civil_to_utc, instant_offset, shift_to_utc, with_civil_instants, with_standard_offsets
from tideglass.operators import gates, views
from tideglass.plans import members, tables
from tideglass.plans.pages import Collected, PageLayout, collect_pages
from tideglass.queries import _BUCKET, _ORDER_DAYS, _ZONED, _order_days, _sql_text, _text, query
from tideglass.recast import EVENTS, events_long, table
from tideglass.session import kept, shared_path
from tideglass.sources import lines as sources
from tideglass.spec import DatasetSpec, Registry, VariableSpec
from tideglass.store import Store, StoreError
from tideglass.streaming.files import ingest_new_files

# pages: the events of a user and day as CSV, with the parts of the date, a composed key, a publisher's UTC clock and a flag

_PAGE = ["STATION", "LOCAL_DATE", "LOCAL_YEAR", "LOCAL_MONTH", "LOCAL_DAY", "LOCAL_HOUR", "ID", "UTC_DATE", "VALUE", "VALUE_FLAG", "EVENT"]
_PAGE_SQL = f"p AS (SELECT {_ZONED}, event_id, event_type, value, user_id, 'page' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS source FROM events QUALIFY count(*) OVER (PARTITION BY user_id, date_trunc('minute', ts)) = 1)"


def _pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(pages, counts): of every user and day a page and the published number of its rows.

    Of minutes with several events of a user none is published. Every 50th event has the publisher's clock wrong by a
    minute, every 7th a text marker for a value, and every 5th a flag.
    """
    e = table(spark, sf_dir, "events").withColumn("local", F.date_trunc("minute", F.col("ts").cast("timestamp")))
    alone = e.withColumn("n", F.count("*").over(Window.partitionBy("user_id", "local"))).filter("n = 1")
    offset = F.get(F.array(*(F.lit(int(h * 60)) for _, h in recast.ZONES)), (F.col("user_id") % 5).cast("int"))
    station, day, k = F.lpad(F.col("user_id").cast("string"), 6, "0"), F.to_date("ts"), F.col("event_id")
    clock = [f("local").cast("string") for f in (F.year, F.month, F.dayofmonth, F.hour)]
    utc = shift_to_utc(F.col("local"), offset * 60) + F.make_dt_interval(mins=(k % 50 == 0).cast("int"))
    line = F.concat_ws(
        ",", station, F.date_format("local", "yyyy-MM-dd HH:mm:ss"), *clock, F.concat_ws(".", station, *clock), F.date_format(utc, "yyyy-MM-dd HH:mm:ss"),
        F.when(k % 7 == 0, "M").otherwise(F.col("value").cast("string")), F.when(k % 5 == 0, "E").otherwise(""), k.cast("string"),
    )
    source = F.concat(F.lit("page"), F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyy-MM-dd"))
    # a page a user and day; written, or the events would be dealt again for each use of the pages and their counts
    made = kept(alone.groupBy(source.alias("source"), station.alias("climate_id"), day.alias("day")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("local", line.alias("line")))), lambda x: x["line"]), "\r\n").alias("rows"), F.count("*").alias("n")), "made-pages")
    body = F.concat(F.lit(",".join(_PAGE) + "\r\n"), "rows", F.lit("\r\n"))
    hits = F.concat(F.lit('{"type":"FeatureCollection","features":[],"numberMatched":'), F.col("n").cast("string"), F.lit("}"))
    return made.select("source", body.alias("body")), made.select("source", "climate_id", "day", sources.hits_count(hits).alias("matched"))


_LAYOUT = PageLayout(
    _PAGE, "STATION", "LOCAL_DATE", "UTC_DATE", ["LOCAL_YEAR", "LOCAL_MONTH", "LOCAL_DAY", "LOCAL_HOUR"], "ID", constants=["STATION"], numbers=["VALUE"], markers={"M": ["VALUE"]}, flags=["VALUE_FLAG"],
)


def _collected(spark: SparkSession, sf_dir: str) -> Collected:
    pages, counts = _pages(spark, sf_dir)
    start = F.col("day").cast("timestamp")
    return collect_pages(pages, counts.select("source", "climate_id", start.alias("window_start"), (start + F.expr("INTERVAL '1' DAY")).alias("window_end"), "matched"), recast.user_zones(spark, sf_dir), _LAYOUT)


@query(f"""WITH {_PAGE_SQL} SELECT event_id, entity_id, {_sql_text("date_trunc('minute', ts) - INTERVAL 1 HOUR - to_minutes(m)")} AS time_start, {_sql_text("date_trunc('minute', ts) - to_minutes(m)")} AS time_end,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value, CASE WHEN event_id % 5 = 0 THEN 'E' END AS flag FROM p WHERE event_id % 50 <> 0""")
def page_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages in one job: counts, constant columns, record keys, windows, markers in their scope, zones, publisher's clocks."""
    return _collected(spark, sf_dir).result.accepted.select(F.col("EVENT").cast("long").alias("event_id"), "entity_id", _text("time_start"), _text("time_end"), F.col("VALUE").alias("value"), F.col("VALUE_FLAG").alias("flag"))


@query(f"""WITH {_PAGE_SQL} SELECT source, count(*) AS physical, count(*) FILTER (event_id % 50 <> 0) AS published, count(*) FILTER (event_id % 50 = 0) AS set_aside,
    CASE WHEN count(*) FILTER (event_id % 50 = 0) > 0 THEN 'publisher_utc_mismatch:' || CAST(count(*) FILTER (event_id % 50 = 0) AS VARCHAR) ELSE '' END AS reasons, true AS balanced FROM p GROUP BY source""")
def page_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each page gave: published, set aside and why; both are all its rows."""
    return _collected(spark, sf_dir).accounts


@query(f"""WITH {_PAGE_SQL} SELECT source, 'VALUE_FLAG' AS "column", 'E' AS value, count(*) AS n FROM p WHERE event_id % 5 = 0 GROUP BY source""")
def page_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of each page and how often they occur."""
    return _collected(spark, sf_dir).flags


@query(f"""WITH {_PAGE_SQL} SELECT count(DISTINCT entity_id) AS stations, min(strftime(ts, '%Y-%m-%d')) AS first_day, max(strftime(ts, '%Y-%m-%d')) AS last_day, count(DISTINCT source) AS pages, count(*) AS matched,
    count(*) FILTER (event_id % 50 <> 0) AS published, count(*) FILTER (event_id % 50 = 0) AS set_aside FROM p""")
def collection_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row on the whole collection, as a run keeps it."""
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    last = day(F.col("last_window") - F.expr("INTERVAL '1' DAY"))
    return _collected(spark, sf_dir).record.select("stations", day("first_window").alias("first_day"), last.alias("last_day"), "pages", "matched", "published", "set_aside")


@query("""WITH p AS (SELECT o_custkey, min(o_orderdate) AS s, max(o_orderdate) AS e FROM orders GROUP BY 1), c AS (SELECT o_custkey, min(o_orderdate) AS cs, max(o_orderdate) AS ce FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1)
    SELECT CAST(o_custkey AS VARCHAR) AS entity_id FROM p WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.o_custkey = p.o_custkey AND p.s >= cs AND p.e <= ce)""")
def shrink_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a replacement that is allowed to shrink leaves out."""
    o = table(spark, sf_dir, "orders").withColumn("entity_id", F.col("o_custkey").cast("string"))
    rng = lambda df: df.groupBy("entity_id").agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))
    return gates.refuse_shrinking(rng(o), rng(o.filter("o_orderstatus <> 'F'")), "allowed").select("entity_id")


# scalars


@query("""SELECT o_orderkey, o_orderkey % 40 BETWEEN 5 AND 31 AND o_orderkey % 3 <> 0 AS whole, o_orderkey % 4 <> 1 AS same, o_totalprice * 0.1::DOUBLE AS tenth,
    o_orderdate + INTERVAL 30 DAY <= TIMESTAMP '1997-01-01' AS settled, CASE WHEN o_orderkey % 2 = 0 THEN -18000 ELSE -14400 END AS offset_seconds FROM orders""")
def scalar_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers within bounds, equal coordinates, scaled values, settled windows, the offset of a clock at a day's end."""
    k, o = F.col("o_orderkey"), table(spark, sf_dir, "orders")
    number = F.concat((k % 40).cast("string"), F.when(k % 3 == 0, ".5").otherwise(""))
    other = F.concat(k.cast("string"), F.when(k % 4 == 1, ".001").otherwise(".0"))
    return o.select(
        "o_orderkey", S.whole_within(number, 5, 31).alias("whole"), S.same_coordinate(k.cast("string"), other).alias("same"), S.scaled(F.col("o_totalprice"), 0.1).alias("tenth"),
        tables.settled(F.col("o_orderdate").cast("timestamp"), F.lit("1997-01-01").cast("timestamp"), 30).alias("settled"), instant_offset(F.col("o_orderdate"), F.lit(-18000), F.lit(-14400), k % 2 == 1).alias("offset_seconds"),
    )


@query(f"""WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, year(o_orderdate) AS y FROM orders), r AS (SELECT *, make_date(y, 4, 1) AS a, make_date(y, 10, 31) AS z FROM d)
    SELECT o_orderkey, {_sql_text("d + INTERVAL 12 HOUR + CASE WHEN d >= a + CAST((7 - dayofweek(a)) % 7 AS INTEGER) AND d < z - CAST(dayofweek(z) AS INTEGER) THEN INTERVAL 4 HOUR ELSE INTERVAL 5 HOUR END")} AS noon FROM r WHERE y BETWEEN 1987 AND 2006""")
def civil_noons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noon on days with and without daylight saving as an instant."""
    at = F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL '12' HOUR")
    return table(spark, sf_dir, "orders").filter(F.year("o_orderdate").between(1987, 2006)).select("o_orderkey", _text(civil_to_utc(at, "America/Toronto"), "noon"))


@query(f"""SELECT lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS entity_id, count(*) AS n, CAST(max(o_totalprice) AS DOUBLE) AS top FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 3 <> 0 GROUP BY 1""")
def approved_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader's own filters on approval and qualifiers, behind the job."""
    from tideglass.queries import queries

    rows = queries()["unit_values"](spark, sf_dir)
    return rows.filter((F.col("approval") == "Approved") & (F.col("qualifiers") != "[]")).groupBy("entity_id").agg(F.count("*").alias("n"), F.max("value").alias("top"))


# files


@query("""SELECT 'unit_' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') || '_' || strftime(max(o_orderdate), '%Y%m%d') || '.csv' AS file_name, lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS station, strftime(max(o_orderdate), '%Y%m%d') AS first_day,
    row_number() OVER (ORDER BY lpad(CAST(o_custkey AS VARCHAR), 7, '0')) AS place FROM orders GROUP BY o_custkey""")
def manifest_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tab-separated manifest, read back, its names checked, taken apart, and set in the order of retrieval."""
    o = table(spark, sf_dir, "orders").groupBy(F.lpad(F.col("o_custkey").cast("string"), 7, "0").alias("station")).agg(F.date_format(F.max("o_orderdate"), "yyyyMMdd").alias("day"), F.count("*").alias("n"))
    path = shared_path(spark, "manifest")
    o.select("station", F.concat(F.lit("unit_"), "station", F.lit("_"), "day", F.lit(".csv")).alias("file_name"), F.col("n").cast("string").alias("rows")).write.csv(path, sep="\t", header=True)
    pattern = r"^unit_(\d{7})_(\d{8})\.csv$"
    members = sources.check_members(sources.read_manifest(spark, path, ["station", "file_name", "rows"]), "file_name", pattern)
    named = members.select("file_name", F.regexp_extract("file_name", pattern, 1).alias("station"), F.regexp_extract("file_name", pattern, 2).alias("first_day"))
    return tables.retrieval_order(named, ["station", "first_day"]).select("file_name", "station", "first_day", "place")


@query(f"""SELECT lpad(CAST(user_id AS VARCHAR), 6, '0') AS entity_id, {_sql_text("max(ts) + INTERVAL 6 HOUR - INTERVAL 10 MINUTE")} AS time_start, CASE WHEN user_id % 6 = 0 THEN NULL ELSE CAST(count(*) AS DOUBLE) END AS power, CASE WHEN user_id % 4 = 0 THEN NULL ELSE 'ok' END AS power_quality
    FROM events GROUP BY user_id, date_trunc('day', ts)""")
def wide_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide CSV with marks for missing values, read back as text and typed by its declaration."""
    e, k = table(spark, sf_dir, "events"), F.col("user_id")
    days = e.groupBy("user_id", F.to_date("ts")).agg(F.max("ts").alias("at"), F.count("*").alias("n"))
    path = shared_path(spark, "wide")
    days.select(
        F.lpad(k.cast("string"), 6, "0").alias("id"), F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"), F.when(k % 6 == 0, "N/A").otherwise(F.col("n").cast("string")).alias("p"), F.when(k % 4 == 0, "-9").otherwise("ok").alias("q")
    ).write.csv(path, header=True)
    read = sources.read_wide_csv(spark, path, ["id", "at", "p", "q"], ["-9"])
    spec = DatasetSpec("readings", storage="wide", timezone="America/Regina", variables=(VariableSpec("power", "kW", quality_field="power_quality"),))
    return tables.parse_wide(read, spec, "id", "at", {"power": "p", "power_quality": "q"}, "end").accepted.select("entity_id", _text("time_start"), "power", "power_quality")


@query(f"""WITH t AS (SELECT s_suppkey, CAST(s_nationkey * 2 AS DOUBLE) AS x FROM supplier), g AS (SELECT DISTINCT p_size FROM part),
    b AS (SELECT s_suppkey, p_size FROM t, g QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY abs(p_size - x), p_size) = 1)
    SELECT CAST(s_suppkey AS VARCHAR) AS entity_id, count(*) AS n, min(p_retailprice) AS least, '2023-12-31 23:00:00.000000' AS time_start FROM b JOIN part USING (p_size) GROUP BY 1""")
def grid_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values of the grid point nearest each target, all in the declared unit: how many, and the least."""
    grid = table(spark, sf_dir, "part").select("p_size", F.lit("K").alias("unit"), F.col("p_retailprice").cast("double").alias("price"), F.lit("2024-01-01").cast("timestamp").alias("time"))
    targets = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("entity_id"), (F.col("s_nationkey") * 2).cast("double").alias("x"))
    found = tables.parse_grid(grid, targets, "price", "unit", "K", [("p_size", "x")], n=F.count("*"), least=F.min("price"))
    return found.groupBy("entity_id").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.min(F.date_format("time_start", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("time_start"))


#: The encoder clears tables of its dictionary's size for each file, and a customer's file is small.
_XZ = [{"id": lzma.FILTER_LZMA2, "preset": 0, "dict_size": 1 << 16}]


def _packed(name: str, text: str) -> bytes:
    return lzma.compress(text.encode(), filters=_XZ) if name.endswith(".xz") else gzip.compress(text.encode(), 1) if name.endswith(".gz") else text.encode()


def _unit_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_name, content): a customer's orders as corrected unit values, every third file as xz, every third as gzip."""
    o, station = table(spark, sf_dir, "orders"), F.lpad(F.col("o_custkey").cast("string"), 7, "0")
    line = F.concat_ws(",", F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00'Z'"), F.lit("local"), F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.when(F.col("o_orderstatus") == "P", "Provisional").otherwise("Approved"), F.lit("20"), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderpriority")))
    body = o.groupBy("o_custkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("o_orderdate", "o_orderkey", line.alias("line")))), lambda x: x["line"]), "\r\n").alias("rows"), F.date_format(F.min("o_orderdate"), "yyyyMMdd").alias("day"))  # a customer's orders make one file
    suffix = F.element_at(F.array(F.lit(".xz"), F.lit(".gz"), F.lit("")), (F.col("o_custkey") % 3 + 1).cast("int"))
    name = F.concat(F.lit("unit_"), station, F.lit("_"), "day", F.lit(".csv"), suffix)
    text = F.concat(F.lit("# Station: "), station, F.lit("\r\n# Unit: USD\r\nUTC, Local, Value, Approval, Grade, Qualifiers\r\n"), "rows", F.lit("\r\n,,,,,\r\n"))

    def pack(batches):
        for b in batches:
            made = [_packed(n, t) for n, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.binary())], names=["file_name", "content"])

    return kept(body.select(name.alias("file_name"), text.alias("text")).mapInArrow(pack, "file_name string, content binary"), "members")


@query(f"""WITH n AS (SELECT o_custkey, strftime(min(o_orderdate), '%Y%m%d') AS d FROM orders GROUP BY 1)
    SELECT lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS entity_id, {_sql_text('o_orderdate')} AS time_start, o_totalprice AS value, CASE WHEN o_orderstatus = 'P' THEN 'Provisional' ELSE 'Approved' END AS approval, CASE WHEN o_orderkey % 3 = 0 THEN '[]' ELSE '["' || o_orderpriority || '"]' END AS qualifiers,
    'unit_' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') || '_' || d || '.csv' || CASE o_custkey % 3 WHEN 0 THEN '.xz' WHEN 1 THEN '.gz' ELSE '' END AS file_name, 3 + row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS line_number
    FROM orders JOIN n USING (o_custkey) JOIN customer ON c_custkey = o_custkey WHERE c_acctbal <= 5000""")
def member_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compressed files of a manifest, their sizes and digests proven, those of small stations read as one table with the file and line of each value."""
    files = _unit_files(spark, sf_dir)
    manifest = kept(members.file_digests(files), "manifest")
    areas = table(spark, sf_dir, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 7, "0").alias("station"), F.col("c_acctbal").cast("double").alias("area"))
    found = members.corrected_values(files, manifest, r"^unit_(\d{7})_(\d{8})\.csv(?:\.xz|\.gz)?$", ["UTC", "Local", "Value", "Approval", "Grade", "Qualifiers"], areas=areas, limit=5000.0, width=8)
    return found.accepted.select("entity_id", _text("time_start"), "value", "approval", "qualifiers", "file_name", "line_number")


@query("""WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, row_number() OVER (ORDER BY strftime(o_orderdate, '%Y-%m')) AS k FROM orders GROUP BY 1)
    SELECT month, CASE k % 28 WHEN 0 THEN 'missing_file' WHEN 7 THEN 'size_differs' WHEN 14 THEN 'digest_differs' WHEN 21 THEN 'bad_digest' END AS fault FROM m""")
def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of each month's orders on disk against a manifest that is wrong on every seventh."""
    o = table(spark, sf_dir, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    line = F.concat_ws(",", F.lpad(F.col("o_orderkey").cast("string"), 12, "0"), F.col("o_custkey").cast("string"))
    text = o.groupBy("month").agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("text"))  # a month makes one file
    k = F.row_number().over(Window.orderBy("month"))  # months
    made = kept(text.withColumn("k", k), "months")
    path = shared_path(spark, "listed")
    made.filter("k % 28 <> 0").select("month", "text").repartition("month").write.partitionBy("month").text(path)
    body = F.concat("text", F.lit("\n")).cast("binary")
    digest = F.when(F.col("k") % 28 == 14, F.sha2(F.col("month").cast("binary"), 256)).when(F.col("k") % 28 == 21, F.lit("none")).otherwise(F.sha2(body, 256))
    manifest = made.select(F.col("month").alias("file_name"), (F.octet_length(body) + F.when(F.col("k") % 28 == 7, 1).otherwise(0)).alias("size_bytes"), digest.alias("sha256"))
    files = members.read_files(spark, f"{path}/*/*.txt").select(F.regexp_extract("path", "month=([^/]+)/", 1).alias("file_name"), "content")
    return members.check_listed(manifest, members.file_digests(files)).select(F.col("file_name").alias("month"), "fault")


@query("""WITH w AS (SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY ALL), p AS (SELECT o_custkey FROM w GROUP BY 1)
    SELECT o_custkey AS climate_id, y, n AS matched, CASE o_custkey % 9 WHEN 0 THEN 'bad_digest' WHEN 2 THEN 'unsafe_name' WHEN 4 THEN 'not_within_a_year' WHEN 6 THEN 'repeated_name' WHEN 8 THEN CASE WHEN n > 1 THEN 'pages_incomplete' END END AS fault FROM w""")
def manifest_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a year whose pages are named, digested and numbered wrongly by the customer's number."""
    c = F.col("climate_id")
    w = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("climate_id"), F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))
    offsets = F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(1).cast("long"))
    pages = w.select("climate_id", "y", "n", F.lit("page").alias("role"), F.explode(offsets).alias("page_offset")).filter(~((c % 9 == 8) & (F.col("page_offset") == F.col("n") - 1) & (F.col("n") > 1)))
    rows = pages.unionByName(w.select("climate_id", "y", "n", F.lit("hits").alias("role"), F.lit(None).cast("long").alias("page_offset")))
    name = F.concat_ws("-", F.when(c % 9 == 6, F.lit("file")).otherwise(F.col("role")), c.cast("string"), F.when(c % 9 == 6, F.lit("all")).otherwise(F.col("y").cast("string")), F.when(c % 9 == 6, F.lit("x")).otherwise(F.coalesce(F.col("page_offset").cast("string"), F.lit("n"))))
    start = F.make_timestamp("y", F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    end = F.make_timestamp(F.col("y") + 1, F.lit(1), F.when(c % 9 == 4, 2).otherwise(1), F.lit(0), F.lit(0), F.lit(0))
    digest = F.sha2(name.cast("binary"), 256)
    manifest = rows.select(
        "climate_id", "role", "page_offset", F.col("n").alias("number_matched"), start.alias("window_start"), end.alias("window_end"),
        F.concat(F.when(c % 9 == 2, F.lit("../")).otherwise(""), name, F.lit(".csv")).alias("file_name"), F.when(c % 9 == 0, F.substring(digest, 1, 63)).otherwise(digest).alias("sha256"),
    )
    return tables.check_manifest(manifest, 1).select("climate_id", F.year("window_start").cast("long").alias("y"), "matched", "fault")


@query("""SELECT doc, count(*) AS n_lines, CAST(sum(k * o_orderkey) AS BIGINT) AS weight FROM (SELECT year(o_orderdate) * 100 + month(o_orderdate) AS doc, o_orderkey, row_number() OVER (PARTITION BY year(o_orderdate), month(o_orderdate) ORDER BY o_orderkey) AS k FROM orders) GROUP BY 1""")
def streamed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each month's orders, as they arrive: half of them in a first call, the rest in a second, each once."""
    doc = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("long").alias("doc")
    orders = table(spark, sf_dir, "orders").select(doc, F.col("o_orderkey").cast("string").alias("value"), "o_orderkey")
    inbox, out, checkpoint = (shared_path(spark, x) for x in ("inbox", "lines", "checkpoint"))

    def handle(lines: DataFrame, batch: int) -> None:
        lines.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    for half in (0, 1):
        orders.filter(F.col("doc") % 2 == half).repartition("doc").sortWithinPartitions("doc", "o_orderkey").drop("o_orderkey").write.mode("append").partitionBy("doc").text(inbox)
        ingest_new_files(spark, f"{inbox}/*", checkpoint, handle, "*.txt")
    lines = spark.read.schema("source string, line_number long, raw string").parquet(out)
    return lines.groupBy(F.regexp_extract("source", "doc=([0-9]+)/", 1).cast("long").alias("doc")).agg(F.count("*").alias("n_lines"), F.sum(F.col("line_number") * F.col("raw").cast("long")).alias("weight"))


@query("""SELECT count(*) AS n_lines, CAST(sum(n * length(raw)) AS BIGINT) AS weight FROM (SELECT row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS n, c_name || ' ' || c_mktsegment AS raw FROM customer)""")
def stored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files with numbered lines, dealt over blocks."""
    c, path = table(spark, sf_dir, "customer"), shared_path(spark, "text")
    c.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey").select("c_nationkey", F.concat_ws(" ", "c_name", "c_mktsegment").alias("value")).write.partitionBy("c_nationkey").text(path)
    lines = sources.read_lines(spark, f"{path}/*", "*.txt")
    return lines.agg(F.count("*").alias("n_lines"), F.sum(F.col("line_number") * F.char_length("raw")).alias("weight"))


# clocks on days on which they change


@query(f"""WITH c AS (SELECT o_orderkey, o_orderkey % 3 AS z, CASE o_orderkey % 3 WHEN 0 THEN TIMESTAMP '2023-11-04' WHEN 1 THEN TIMESTAMP '2023-03-11' ELSE TIMESTAMP '2023-10-28' END + to_minutes(CAST(o_orderkey // 3 % 4320 AS INTEGER)) AS t FROM orders),
    d AS (SELECT *, CASE z WHEN 0 THEN CASE WHEN t < TIMESTAMP '2023-11-05 01:00' THEN 240 WHEN t >= TIMESTAMP '2023-11-05 02:00' THEN 300 END WHEN 1 THEN CASE WHEN t < TIMESTAMP '2023-03-12 02:00' THEN 300 WHEN t >= TIMESTAMP '2023-03-12 03:00' THEN 240 END
        ELSE CASE WHEN t < TIMESTAMP '2023-10-29 01:00' THEN -120 WHEN t >= TIMESTAMP '2023-10-29 03:00' THEN 0 END END AS m FROM c)
    SELECT o_orderkey, {_sql_text('t + to_minutes(CAST(m AS INTEGER))')} AS utc, CASE WHEN m IS NOT NULL THEN NULL WHEN z = 1 THEN 'no_such_local_time' ELSE 'ambiguous_local_time' END AS fault FROM d""")
def civil_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Civil clocks of several zones around their changes, by a table of periods; those that occur twice or never are marked."""
    k = F.col("o_orderkey")
    pick = lambda *xs: F.element_at(F.array(*map(F.lit, xs)), (k % 3 + 1).cast("int"))
    at = pick("2023-11-04", "2023-03-11", "2023-10-28").cast("timestamp") + F.make_dt_interval(mins=F.expr("o_orderkey div 3 % 4320").cast("int"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", pick("America/Toronto", "America/Toronto", "Antarctica/Troll").alias("zone"), at.alias("local"))
    return with_civil_instants(rows, "zone", "local", "2023", "2023").select("o_orderkey", _text("instant", "utc"), "fault")


@query(f"""WITH d AS (SELECT event_id, DATE '2020-10-25' + CAST(user_id % 14 AS INTEGER) AS day FROM events)
    SELECT event_id, CASE WHEN day < DATE '2020-11-01' THEN -28800 ELSE -25200 END AS offset_start, CASE WHEN day < DATE '2020-10-31' THEN -28800 ELSE -25200 END AS offset_end, day = DATE '2020-10-31' AS is_transition FROM d""")
def standard_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days around the one on which a zone changed its standard time."""
    rows = table(spark, sf_dir, "events").select("event_id", F.lit("America/Dawson").alias("zone"), F.date_add(F.lit("2020-10-25").cast("date"), (F.col("user_id") % 14).cast("int")).alias("day"))
    return with_standard_offsets(rows, "zone", "day").select("event_id", "offset_start", "offset_end", "is_transition")


# reads of many entities, trees of digests


@query("""SELECT lpad(CAST(user_id AS VARCHAR), 6, '0') AS entity_id, count(*) AS n FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY') AND ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-25' GROUP BY 1""")
def many_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A read of all entities that another table names."""
    ids = table(spark, sf_dir, "customer").filter("c_mktsegment = 'MACHINERY'").select(F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("entity_id"))
    rows = views.request_filter(events_long(spark, sf_dir), EVENTS, views.normalized_entities(ids), "2024-01-03", "2024-01-25")
    return rows.groupBy("entity_id").agg(F.count("*").alias("n"))


@query("""WITH r AS (SELECT sha256('{"l_orderkey":' || CAST(l_orderkey AS VARCHAR) || ',"l_linenumber":' || CAST(l_linenumber AS VARCHAR) || '}') AS d, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber), q AS (SELECT CASE WHEN n = 1 THEN d ELSE d || '*' || CAST(n AS VARCHAR) END AS d FROM r),
    h AS (SELECT least(6, greatest(2, CAST(ceil(ln(count(*) / 64.0) / ln(16.0)) AS INTEGER))) AS depth FROM q), l6 AS (SELECT substr(d, 1, depth) AS lead, sha256(string_agg(d, ',' ORDER BY d)) AS g FROM q, h GROUP BY 1),
    l5 AS (SELECT substr(lead, 1, least(length(lead), 5)) AS lead, CASE WHEN max(length(lead)) > 5 THEN sha256(string_agg(g, ',' ORDER BY lead)) ELSE max(g) END AS g FROM l6 GROUP BY 1),
    l4 AS (SELECT substr(lead, 1, least(length(lead), 4)) AS lead, CASE WHEN max(length(lead)) > 4 THEN sha256(string_agg(g, ',' ORDER BY lead)) ELSE max(g) END AS g FROM l5 GROUP BY 1),
    l3 AS (SELECT substr(lead, 1, least(length(lead), 3)) AS lead, CASE WHEN max(length(lead)) > 3 THEN sha256(string_agg(g, ',' ORDER BY lead)) ELSE max(g) END AS g FROM l4 GROUP BY 1),
    l2 AS (SELECT substr(lead, 1, 2) AS lead, CASE WHEN max(length(lead)) > 2 THEN sha256(string_agg(g, ',' ORDER BY lead)) ELSE max(g) END AS g FROM l3 GROUP BY 1)
    SELECT sha256(string_agg(g, ',' ORDER BY lead) || '|{"rows": "all"}') AS fingerprint FROM l2""")
def deep_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest over many rows, repeated ones among them, by a tree whose leaves hold some 64."""
    return tables.selection_fingerprint(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], {"rows": "all"}, most=64)


# runs and their records


_stores: dict[tuple[str, str], Store] = {}


def _store(spark: SparkSession, sf_dir: str) -> Store:
    """The store of a session and its tables: two appended snapshots of orders with inputs, names, rejections, and a run that failed behind them."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _stores or not _stores[key]._exists(f"{_stores[key].root}/meta"):
        _stores[key] = _published(spark, sf_dir)
    return _stores[key]


def _published(spark: SparkSession, sf_dir: str) -> Store:
    store = Store(spark, shared_path(spark, "store"), Registry([recast.ORDERS]))
    days = _order_days(spark, sf_dir)
    old, new = days.filter(F.year("time_start") < 1998), kept(days.filter(F.year("time_start") >= 1998), "new")  # published twice
    at = F.lit("2024-01-01").cast("timestamp")
    members = kept(days.select("entity_id").distinct(), "members")  # named in three tables
    inputs = members.select(F.concat(F.lit("member:"), "entity_id").alias("input_key"), F.concat(F.lit("src_"), "entity_id").alias("source_id"), F.lit("observation_source").alias("input_role"), F.to_json(F.struct("entity_id")).alias("details_json"))
    plan = spark.createDataFrame([("selection", "src_selection", "selection_manifest", "{}")], "input_key string, source_id string, input_role string, details_json string")
    names = members.select(F.concat(F.lit("src_"), "entity_id").alias("source_id"), F.concat(F.lit("orders of "), "entity_id").alias("original_name"))
    names = names.unionByName(spark.createDataFrame([("first", "first archive"), ("second", "second archive")], "source_id string, original_name string"))
    store._append("source_aliases", names.select(F.md5(F.concat("source_id", "original_name").cast("binary")).alias("alias_id"), "source_id", "original_name", F.lit("").alias("source_uri"), F.lit("").alias("publisher_vintage"), at.alias("fetched_at"), at.alias("recorded_at")))
    store._append("source_files", names.select("source_id", F.col("original_name").alias("path"), F.sha2(F.col("original_name").cast("binary"), 256).alias("sha256"), F.octet_length("original_name").cast("long").alias("size_bytes"), at.alias("registered_at")))
    o = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    lost = o.select(*tables.rejection(F.lpad(F.col("o_custkey").cast("string"), 7, "0"), F.concat(F.lit("line:"), F.col("o_orderkey").cast("string")), F.lit("open"), F.lit("still_open"), F.col("o_orderpriority"), F.lit(0), F.struct("o_orderkey")))
    store.publish(old, "orders_daily", "first", "1+dirty")
    store.publish(new, "orders_daily", "second", "1", rejected=lost, inputs=inputs.unionByName(plan))
    try:
        store.publish(new, "orders_daily", "third", "1")  # the same keys again
    except ValueError:
        return store
    raise StoreError("a collision was published")


@query("""SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'first' ELSE 'second' END AS source_id, count(DISTINCT (o_custkey, o_orderdate)) AS n FROM orders GROUP BY 1""")
def provenance_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a snapshot with the source that each came from."""
    return _store(spark, sf_dir).load("orders_daily", include_provenance=True).groupBy(F.col("_source_id").alias("source_id")).agg(F.count("*").alias("n"))


@query("""SELECT 'orders_daily' AS dataset_id, 'USD' AS unit, count(DISTINCT (o_custkey, o_orderdate)) AS n, 'double' AS kind FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'""")
def result_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a read says of itself: dataset and unit of its value column, and the rows that it covers."""
    found = _store(spark, sf_dir).result("orders_daily", start="1997")
    about = found.rows.schema["total"]
    return found.rows.agg(F.count("*").alias("n")).select(F.lit(about.metadata["dataset_id"]).alias("dataset_id"), F.lit(about.metadata["unit"]).alias("unit"), "n", F.lit(about.dataType.simpleString()).alias("kind"))


@query("""SELECT lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS source, count(*) AS n, count(*) FILTER (o_orderkey % 2 = 0) AS replaced FROM orders WHERE o_orderstatus = 'P' GROUP BY 1""")
def rejections_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejections of one run, recorded twice, half of them changed: one set, the latest of each."""
    store = Store(spark, shared_path(spark, "store"), Registry([recast.ORDERS]))
    o = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    lost = lambda df, reason: df.select(*tables.rejection(F.lpad(F.col("o_custkey").cast("string"), 7, "0"), F.concat(F.lit("line:"), F.col("o_orderkey").cast("string")), F.lit("open"), F.lit(reason), F.col("o_orderpriority"), F.lit(0), F.struct("o_orderkey")))
    store.record_rejections("run_other", "orders_daily", lost(o, "kept_apart"))
    for rows in (lost(o, "first"), lost(o.filter("o_orderkey % 2 = 0"), "again")):
        store.record_rejections("run_one", "orders_daily", rows)
    return store.meta("rejections").filter("run_id = 'run_one'").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("reason") == "again").alias("replaced"))


@query(f"""WITH d AS (SELECT o_custkey, o_orderdate, max(o_totalprice) AS total FROM orders GROUP BY ALL) SELECT lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS entity_id, {_sql_text("date_trunc('year', o_orderdate)")} AS time_start, max(total) AS total FROM d GROUP BY o_custkey, date_trunc('year', o_orderdate)""")
def derived_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset derived from a published snapshot and published itself, with its parent behind it."""
    store = Store(spark, shared_path(spark, "store"), Registry([recast.LATEST_ORDERS, recast.YEARLY_ORDERS]))
    parent = store.publish(_order_days(spark, sf_dir), "orders_latest", "first", "1")
    year = F.date_trunc("year", "time_start")
    made = store.materialize("orders_yearly", [parent], {"max": "year"}, "1", lambda _, p: p[0].groupBy("entity_id", year.alias("time_start")).agg(F.max("time_end").alias("time_end"), F.max("total").alias("total")).select("entity_id", "time_start", "time_end", "total"))
    behind = store.lineage(made).filter("depth = 1").select(F.col("snapshot_id").alias("parent"))
    rows = store.load("orders_yearly").select("entity_id", _text("time_start"), "total")
    return rows.join(behind.filter(F.col("parent") == parent).limit(1)).drop("parent")  # a row: the parent


@query("SELECT DISTINCT 'member:' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS input_key, 'src_' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS source_id FROM orders")
def role_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inputs of one role behind the live snapshot."""
    return _store(spark, sf_dir).latest_inputs("orders_daily", "observation_source").select("input_key", "source_id")


@query("""SELECT DISTINCT 'src_' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS source_id, 'observation_source' AS role, 'orders of ' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS original_name FROM orders
    UNION ALL VALUES ('src_selection', 'selection_manifest', NULL), ('first', 'observation_source', 'first archive'), ('second', 'observation_source', 'second archive')""")
def provenance_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that a snapshot and those it took over rest on, with roles and names."""
    return _store(spark, sf_dir).provenance("orders_daily").select("source_id", "role", "original_name")


@query("SELECT lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS source, 'second archive' AS original_name, 'still_open' AS reason, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1")
def rejection_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejections of committed runs with their sources' names."""
    return _store(spark, sf_dir).rejection_audit().groupBy("source", "original_name", "reason").agg(F.count("*").alias("n"))


@query(f"""WITH d AS (SELECT DISTINCT lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS entity_id, o_orderdate FROM orders)
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, {_BUCKET.format('entity_id', 8)} AS entity_bucket, count(*) AS row_count, CASE WHEN year(o_orderdate) < 1998 THEN 2 ELSE 1 END AS n_snapshots FROM d GROUP BY ALL""")
def fragment_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored fragments, each once, and how many snapshots share them."""
    return _store(spark, sf_dir).fragment_inventory("orders_daily").select("year", "entity_bucket", "row_count", "n_snapshots")


@query("""SELECT 'first archive' AS original_name, '1+dirty' AS version, count(DISTINCT year(o_orderdate) * 8 + b) AS n_fragments FROM (SELECT *, """ + _BUCKET.format("lpad(CAST(o_custkey AS VARCHAR), 7, '0')", 8) + """ AS b FROM orders) WHERE year(o_orderdate) < 1998
    UNION ALL SELECT 'second archive', '1', count(DISTINCT year(o_orderdate) * 8 + b) FROM (SELECT *, """ + _BUCKET.format("lpad(CAST(o_custkey AS VARCHAR), 7, '0')", 8) + """ AS b FROM orders) WHERE year(o_orderdate) >= 1998""")
def runs_behind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs that wrote the live snapshot's fragments."""
    return _store(spark, sf_dir).runs_behind("orders_daily").select("original_name", "version", "n_fragments")


@query("""SELECT 'committed' AS state, 2 AS n, 2 AS committed, 0 AS without_version, 1 AS uncommitted_code, count(*) AS rows FROM (SELECT DISTINCT o_custkey, o_orderdate FROM orders)
    UNION ALL SELECT 'failed', 1, 2, 0, 1, count(*) FROM (SELECT DISTINCT o_custkey, o_orderdate FROM orders)""")
def run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs by state, what their code records say, and the rows of live fragments."""
    store = _store(spark, sf_dir)
    rows = store.fragment_inventory("orders_daily").agg(F.sum("row_count").alias("rows"))
    return store.runs().groupBy("state").agg(F.count("*").alias("n")).join(store.code_summary()).join(rows)  # a row each


@query("""SELECT 'warning' AS severity, 'unreferenced_file' AS code, count(DISTINCT year(o_orderdate) * 8 + b) AS n FROM (SELECT *, """ + _BUCKET.format("lpad(CAST(o_custkey AS VARCHAR), 7, '0')", 8) + """ AS b FROM orders) WHERE year(o_orderdate) >= 1998""")
def store_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings on the stored files: those of the failed run are nobody's."""
    return _store(spark, sf_dir).audit().groupBy("severity", "code").agg(F.count("*").alias("n"))


@query(_ORDER_DAYS.format("o_orderdate >= TIMESTAMP '1998-01-01'"))
def stored_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over the views of a store's datasets."""
    _store(spark, sf_dir).connect()
    return spark.sql("SELECT entity_id, date_format(time_start, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS time_start, total FROM orders_daily WHERE time_start >= timestamp '1998-01-01'")


@query("SELECT CASE WHEN o_custkey % 2 = 0 THEN NULL ELSE 'even keys only' END AS error, count(DISTINCT o_custkey) AS n FROM orders GROUP BY 1")
def replayed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source once more, in the order of names; failures are reported and don't stop the rest."""

    def job(source: str, path: str) -> str:
        if source.startswith("src_") and int(source[4:]) % 2:
            raise ValueError("even keys only")
        return source

    done = _store(spark, sf_dir).replay("orders_daily", job)
    return done.filter(F.col("source_id").startswith("src_")).groupBy("error").agg(F.count("*").alias("n"))
