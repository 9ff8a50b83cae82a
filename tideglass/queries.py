"""The registered queries over the driver's tables and the SQL that returns the same rows.

Times leave as text, so that engines need not agree on a session's zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideglass import recast
from tideglass.functions import scalars as S
from tideglass.functions.station_time import civil_to_utc, shift_to_utc, with_standard_offsets
from tideglass.operators import analysis, gates, views
from tideglass.plans import fixed_width, tables
from tideglass.recast import EVENT_TYPES, EVENTS, events_long, table
from tideglass.session import shared_path
from tideglass.sources import lines as sources
from tideglass.spec import Registry, SentinelRule
from tideglass.store import Store, closure, preferred_names

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

_EV = """ev AS (SELECT lpad(CAST(user_id AS VARCHAR), 6, '0') AS entity_id, ts AS time_start, ts + INTERVAL 10 MINUTE AS time_end,
    event_type AS variable, value FROM events)"""
_BUCKET = "CAST(CAST('0x' || substr(md5({}), 1, 15) AS BIGINT) % {} AS INTEGER)"


def _text(at: str | Column, name: str | None = None) -> Column:
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name or at)


def _sql_text(at: str) -> str:
    return f"strftime({at}, '%Y-%m-%d %H:%M:%S.%f')"


def query(sql: str | None = None):
    def register(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def _registered() -> None:
    from tideglass import job_queries  # noqa: F401 - registers its own


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _registered()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _registered()
    return dict(_SQL)


# logical reads


@query(f"""WITH {_EV} SELECT entity_id, {_sql_text('time_start')} AS time_start, {_sql_text('time_end')} AS time_end,
    max(value) FILTER (variable = 'click') AS click, max(value) FILTER (variable = 'error') AS error
    FROM ev WHERE entity_id = '000008' AND time_start >= TIMESTAMP '2024-01-03' AND time_start < TIMESTAMP '2024-01-20' GROUP BY ALL""")
def load_entity_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entity, two variables, a stretch of time, as one row an interval."""
    stored = views.request_filter(events_long(spark, sf_dir), EVENTS, views.normalized_entities("000008"), "2024-01-03", "2024-01-20")
    view = views.logical_view(stored, EVENTS, views.normalized_variables(EVENTS, ["click", "error"]))
    return views.ordered(view, EVENTS).select("entity_id", _text("time_start"), _text("time_end"), "click", "error")


@query(f"""WITH {_EV} SELECT entity_id, {_sql_text('time_start')} AS time_start, {', '.join(f"max(value) FILTER (variable = '{t}') AS {t}" for t in EVENT_TYPES)}
    FROM ev GROUP BY entity_id, ev.time_start, time_end""")
def guarded_pivot_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All variables of all entities; a key that held a variable twice would end the job."""
    return views.guarded_pivot(events_long(spark, sf_dir), EVENTS, EVENT_TYPES).select("entity_id", _text("time_start"), *EVENT_TYPES)


@query(f"""WITH {_EV} SELECT entity_id, {_sql_text('time_start')} AS time_start, variable, value FROM ev ORDER BY ev.time_start, entity_id, variable LIMIT 100""")
def earliest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A limited read in full key order (the limit is the feature)."""
    return events_long(spark, sf_dir).orderBy("time_start", "entity_id", "variable").limit(100).select("entity_id", _text("time_start"), "variable", "value")


@query(f"WITH {_EV} SELECT entity_id, strftime(time_start, '%Y-%m-%d') AS day, string_agg(DISTINCT variable, ',' ORDER BY variable) AS variables FROM ev GROUP BY ALL")
def distinct_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct texts of a group in one ordered string, as lineage columns are built."""
    return events_long(spark, sf_dir).groupBy("entity_id", F.date_format("time_start", "yyyy-MM-dd").alias("day")).agg(views.distinct_text("variable").alias("variables"))


@query(f"""SELECT CAST(user_id AS VARCHAR) AS entity_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type, value FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) BETWEEN 10 AND 19""")
def json_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed reads out of a JSON text column, and a predicate on one."""
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("entity_id"), k.alias("k"), "event_type", "value").filter("k between 10 and 19")


# gates


@query(f"WITH {_EV} SELECT entity_id, {_sql_text("date_trunc('hour', time_start)")} AS hour, variable, count(*) AS n FROM ev GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that repeat once times are cut to hours."""
    hourly = events_long(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "time_start"))
    return gates.duplicate_keys(hourly, ["entity_id", "hour", "variable"]).withColumn("hour", _text("hour"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT count(*) AS n_rows, count(*) FILTER (l_orderkey IS NULL) AS entity_missing, count(*) FILTER (l_shipdate IS NULL) AS time_start_missing, 0 AS time_end_missing,
    count(*) FILTER (l_linenumber % 4 = 0) AS interval_not_positive, count(*) FILTER (l_returnflag <> 'A') AS variable_undeclared FROM lineitem""")
def row_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All row rules in one pass, over rows of which some break them."""
    spec = recast.DatasetSpec("lines", variables=(recast.VariableSpec("A", "1"),))
    at = F.col("l_shipdate").cast("timestamp")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("entity_id"), at.alias("time_start"), F.date_add(at, F.col("l_linenumber") % 4).cast("timestamp").alias("time_end"), F.col("l_returnflag").alias("variable"), F.col("l_quantity").alias("value"))
    counts = gates.rule_counts(rows, spec)
    return counts.select("n_rows", "entity_missing", "time_start_missing", F.col("time_end_missing").cast("int"), "interval_not_positive", "variable_undeclared")


@query(f"WITH {_EV} SELECT variable, 0.5::DOUBLE AS q, quantile_cont(value, 0.5) AS measured, count(value) AS n FROM ev GROUP BY variable")
def plausibility_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact quantile that each variable's band is checked against."""
    return gates.band_quantiles(events_long(spark, sf_dir), EVENTS)


@query("""SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM (SELECT DISTINCT o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'P')
    SEMI JOIN (SELECT o_custkey, o_orderdate FROM orders WHERE o_orderstatus <> 'P') USING (o_custkey, o_orderdate)""")
def key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of new rows that prior rows hold, read only in the partitions that the new rows touch."""
    at = F.col("o_orderdate").cast("timestamp")
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("entity_id"), at.alias("time_start"), (at + F.expr("INTERVAL '1' DAY")).alias("time_end"), F.col("o_totalprice").alias("total"), "o_orderstatus")
    placed = views.with_partitions(rows, recast.ORDERS)
    new, prior = placed.filter("o_orderstatus = 'P'"), placed.filter("o_orderstatus <> 'P'")
    found = gates.collisions(new, prior, recast.ORDERS).distinct()
    return found.select(F.col("entity_id").cast("long").alias("o_custkey"), F.date_format("time_start", "yyyy-MM-dd").alias("day"))


@query(f"""WITH {_EV} SELECT year(time_start) AS year, {_BUCKET.format('entity_id', 8)} AS entity_bucket, count(*) AS row_count, {_sql_text('min(time_start)')} AS min_time, {_sql_text('max(time_end)')} AS max_time FROM ev GROUP BY ALL""")
def fragment_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and time bounds of each file partition."""
    placed = views.with_partitions(events_long(spark, sf_dir), EVENTS)
    stats = placed.groupBy("year", "entity_bucket").agg(F.count("*").alias("row_count"), F.min("time_start").alias("min_time"), F.max("time_end").alias("max_time"))
    return stats.select(F.col("year").cast("long"), "entity_bucket", "row_count", _text("min_time"), _text("max_time"))


# profiles


@query("""SELECT field, flag, count(*) AS n FROM (SELECT 'l_returnflag' AS field, l_returnflag AS flag FROM lineitem UNION ALL SELECT 'l_linestatus', l_linestatus FROM lineitem)
    WHERE trim(flag) <> '' GROUP BY ALL""")
def flag_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.flag_distribution(table(spark, sf_dir, "lineitem"), r"l_.*(flag|status)")


@query("""SELECT event_type, count(*) FILTER (value < 1) AS calm, count(*) FILTER (value IS NULL) AS missing, count(*) FILTER (value >= 100) AS high, count(value) AS n_values, min(value) AS least, max(value) AS most
    FROM events GROUP BY event_type""")
def conditional_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    found = analysis.counts_where(table(spark, sf_dir, "events"), ["event_type"], {"calm": value < 1, "missing": value.isNull(), "high": value >= 100}, "value")
    return found.drop("n")


@query("SELECT event_type, count(value) AS n, min(value) AS least, max(value) AS most, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.9) AS p90, quantile_cont(value, 0.99) AS p99 FROM events GROUP BY 1")
def value_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.value_profile(table(spark, sf_dir, "events"), "event_type", "value")


@query(f"""SELECT event_type, {_sql_text("date_trunc('day', ts)")} AS period, count(*) AS n_rows, count(value) AS n_values FROM events GROUP BY ALL""")
def coverage_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = analysis.coverage(table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"], "value", "day")
    return found.withColumn("period", _text("period"))


@query(f"WITH {_EV} SELECT count(*) AS n_rows, count(DISTINCT entity_id) AS n_entities, count(DISTINCT (entity_id, time_start, time_end, variable)) AS n_keys FROM ev")
def entity_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.cardinalities(events_long(spark, sf_dir), "entity_id", EVENTS.key_columns)


@query("""SELECT n_name, count(*) AS n, count(*) FILTER (c_acctbal < 0) AS overdrawn, count(*) FILTER (c_mktsegment = 'MACHINERY') AS machinery FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def attribute_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities by an attribute of the inventory."""
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    rows = analysis.enriched(table(spark, sf_dir, "customer"), nations, "c_nationkey", ["n_name"])
    return analysis.counts_where(rows, ["n_name"], {"overdrawn": F.col("c_acctbal") < 0, "machinery": F.col("c_mktsegment") == "MACHINERY"})


@query("SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 ORDER BY n DESC, n_name LIMIT 5")
def top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.leading(attribute_profile(spark, sf_dir).select("n_name", "n"), "n", "n_name", 5)


@query("SELECT o_orderstatus AS state, o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY ALL")
def state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.counts_where(table(spark, sf_dir, "orders").withColumnsRenamed({"o_orderstatus": "state", "o_orderpriority": "priority"}), ["state", "priority"], {})


@query("""SELECT n_name, count(DISTINCT o_orderkey) FILTER (o_orderstatus = 'F') AS committed, count(DISTINCT o_orderkey) FILTER (o_orderstatus = 'O') AS superseded
    FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def dataset_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct snapshots by state for each dataset, those without any included."""
    orders, customers, nations = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    rows = nations.join(customers, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    count = lambda s: F.count_distinct(F.when(F.col("o_orderstatus") == s, F.col("o_orderkey")))
    return rows.groupBy("n_name").agg(count("F").alias("committed"), count("O").alias("superseded"))


# series


@query(f"""WITH {_EV}, r AS (SELECT entity_id, max(time_end) OVER (PARTITION BY entity_id ORDER BY time_start, time_end ROWS UNBOUNDED PRECEDING) AS gap_start,
    lead(time_start) OVER (PARTITION BY entity_id ORDER BY time_start, time_end) AS gap_end FROM ev)
    SELECT entity_id, {_sql_text('gap_start')} AS gap_start, {_sql_text('gap_end')} AS gap_end FROM r WHERE r.gap_end > r.gap_start""")
def gap_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.gaps(events_long(spark, sf_dir), "entity_id", "time_start", "time_end").select("entity_id", _text("gap_start"), _text("gap_end"))


_SPANS = f"""{_EV}, m AS (SELECT entity_id, time_start AS s, time_end + INTERVAL 2 HOUR AS e, max(time_end + INTERVAL 2 HOUR) OVER
    (PARTITION BY entity_id ORDER BY time_start, time_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM ev)"""


@query(f"""WITH {_SPANS}, i AS (SELECT *, sum(CASE WHEN b IS NULL OR s > b THEN 1 ELSE 0 END) OVER (PARTITION BY entity_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM m)
    SELECT entity_id, {_sql_text('min(s)')} AS span_start, {_sql_text('max(e)')} AS span_end FROM i GROUP BY entity_id, k""")
def merged_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches with an event in the last two hours."""
    rows = events_long(spark, sf_dir).withColumn("time_end", F.col("time_end") + F.expr("INTERVAL '2' HOUR"))
    return analysis.merged_spans(rows, "entity_id", "time_start", "time_end").select("entity_id", _text("start", "span_start"), _text("end", "span_end"))


@query(f"""WITH {_SPANS} SELECT entity_id, {_sql_text('s')} AS span_start, {_sql_text('b')} AS earlier_end FROM m WHERE s < b""")
def overlapping_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events_long(spark, sf_dir).withColumn("time_end", F.col("time_end") + F.expr("INTERVAL '2' HOUR"))
    return analysis.overlaps(rows, "entity_id", "time_start", "time_end").select("entity_id", _text("start", "span_start"), _text("earlier_end"))


@query("""WITH p AS (SELECT o_custkey, min(o_orderdate) AS s, max(o_orderdate) AS e FROM orders GROUP BY 1),
    c AS (SELECT o_custkey, min(o_orderdate) AS cs, max(o_orderdate) AS ce FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)
    SELECT o_custkey FROM p WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.o_custkey = p.o_custkey AND p.s >= cs AND p.e <= ce)""")
def uncovered_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published ranges that a new selection would lose."""
    rng = lambda df: df.groupBy("o_custkey").agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))
    orders = table(spark, sf_dir, "orders")
    return analysis.uncovered(rng(orders), rng(orders.filter("o_orderstatus <> 'P'")), "o_custkey").select("o_custkey")


@query(f"""SELECT user_id, {_sql_text("date_trunc('hour', ts)")} AS hour, {_sql_text('ts')} AS at FROM events
    QUALIFY count(*) OVER (PARTITION BY user_id, date_trunc('hour', ts)) > 2""")
def repeated_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of hours that occur more than twice for an entity."""
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    rows = table(spark, sf_dir, "events").withColumn("hour", hour).withColumn("n", F.count("*").over(Window.partitionBy("user_id", "hour")))
    return rows.filter("n > 2").select("user_id", _text("hour"), _text(F.col("ts"), "at"))


_HOURS = """h AS (SELECT t.event_type, g.hour, count(e.value) AS n, coalesce(max(e.value), 0) AS top FROM (SELECT DISTINCT event_type FROM events) t
    CROSS JOIN (SELECT unnest(generate_series(date_trunc('hour', (SELECT min(ts) FROM events)), date_trunc('hour', (SELECT max(ts) FROM events)), INTERVAL 1 HOUR)) AS hour) g
    LEFT JOIN events e ON e.event_type = t.event_type AND date_trunc('hour', e.ts) = g.hour GROUP BY ALL)"""


def _hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_type, hour, n, top) for every hour, those without events included."""
    e = table(spark, sf_dir, "events").select("event_type", "value", F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"))
    seen = e.groupBy("event_type", "hour").agg(F.count("value").alias("n"), F.max("value").alias("top"))
    ends = e.groupBy("event_type").agg(F.lit(1).alias("one")).crossJoin(F.broadcast(e.agg(F.min("hour").alias("a"), F.max("hour").alias("b"))))  # a row a type
    grid = ends.select("event_type", F.explode(F.sequence("a", "b", F.expr("INTERVAL '1' HOUR"))).alias("hour"))
    return grid.join(seen, ["event_type", "hour"], "left").select("event_type", "hour", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("top", F.lit(0.0)).alias("top"))


@query(f"""WITH {_HOURS}, w AS (SELECT n, top, lag(n) OVER o AS n0, lag(top) OVER o AS t0, lead(top) OVER o AS t1 FROM h WINDOW o AS (PARTITION BY event_type ORDER BY hour))
    SELECT count(*) AS n, round(avg(top - t0), 6) AS top_change, round(avg(t1 - top), 6) AS top_after FROM w WHERE t1 IS NOT NULL AND t0 IS NOT NULL AND n > 0 AND n0 = 0""")
def onset_contrast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First hours with events behind one without: how the greatest value changes there and after."""
    found = analysis.onset_contrast(_hours(spark, sf_dir), "event_type", "hour", "n", ["top"])
    return found.select("n", F.round("top_change", 6).alias("top_change"), F.round("top_after", 6).alias("top_after"))


@query(f"""WITH {_HOURS} SELECT a.event_type, {_sql_text('a.hour')} AS hour, a.n AS n_here, b.n AS n_there FROM h a JOIN h b ON a.event_type = b.event_type AND a.hour = b.hour + INTERVAL 1 HOUR WHERE a.n <> b.n""")
def shifted_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source's start is the other's end: an equi join on the shifted key."""
    h = _hours(spark, sf_dir)
    there = h.select("event_type", (F.col("hour") + F.expr("INTERVAL '1' HOUR")).alias("hour"), F.col("n").alias("n_there"))
    return h.withColumnRenamed("n", "n_here").join(there, ["event_type", "hour"]).filter("n_here <> n_there").select("event_type", _text("hour"), "n_here", "n_there")


_DAYS = "SELECT user_id, date_trunc('day', ts) AS day, sum(CAST(round(value * 100) AS BIGINT)) AS amount, count(*) AS n FROM events WHERE event_type = '{}' GROUP BY ALL"


@query(f"""WITH l AS ({_DAYS.format('click')}), r AS ({_DAYS.format('view')}), j AS (SELECT l.amount AS la, r.amount AS ra, l.n AS ln, r.n AS rn FROM l FULL JOIN r USING (user_id, day)),
    u AS (SELECT 'amount' AS variable, la AS a, ra AS b FROM j UNION ALL SELECT 'n', ln, rn FROM j)
    SELECT variable, CASE WHEN a IS NULL AND b IS NULL THEN 'both_null' WHEN b IS NULL THEN 'left_only' WHEN a IS NULL THEN 'right_only' WHEN a = b THEN 'equal' ELSE 'differ' END AS class, count(*) AS n FROM u GROUP BY ALL""")
def source_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources key by key, each variable classed."""
    e = table(spark, sf_dir, "events")
    day = lambda t: e.filter(F.col("event_type") == t).groupBy("user_id", F.date_trunc("day", "ts").alias("day")).agg(F.sum(F.round(F.col("value") * 100).cast("long")).alias("amount"), F.count("*").alias("n"))
    return analysis.compare_sources(day("click"), day("view"), ["user_id", "day"], ["amount", "n"])


# joins


@query("""SELECT r_name, n_name, count(*) AS n, count(*) FILTER (s_acctbal > 0) AS solvent FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def station_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of stations by two levels of their inventory."""
    regions = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    nations = analysis.enriched(table(spark, sf_dir, "nation"), regions, "n_regionkey", ["r_name"]).select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "r_name")
    rows = analysis.enriched(table(spark, sf_dir, "supplier"), nations, "s_nationkey", ["n_name", "r_name"])
    return analysis.counts_where(rows, ["r_name", "n_name"], {"solvent": F.col("s_acctbal") > 0})


@query("SELECT c_custkey FROM customer ANTI JOIN orders ON o_custkey = c_custkey")
def anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("""SELECT count(*) AS n, count(*) FILTER (EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')) AS with_open,
    count(*) FILTER (NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)) AS without_any FROM customer""")
def code_record_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existence counts: entities with an open record, and without any."""
    entities = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return analysis.record_summary(entities, table(spark, sf_dir, "orders"), "o_custkey", {"with_open": F.col("o_orderstatus") == "P"})


@query("""WITH c AS (SELECT o_custkey, year(o_orderdate) AS y, count(*) AS matched FROM orders GROUP BY ALL), p AS (SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n_rows FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL)
    SELECT o_custkey, y, matched, coalesce(n_rows, 0) AS n_rows, matched = coalesce(n_rows, 0) AS complete FROM c LEFT JOIN p USING (o_custkey, y)""")
def window_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate").cast("long"))
    return tables.reconcile_windows(orders.groupBy("o_custkey", "y").agg(F.count("*").alias("matched")), orders.filter("o_orderstatus <> 'P'"), ["o_custkey", "y"])


@query("""WITH j AS (SELECT CASE WHEN s_suppkey IS NULL THEN 'unmatched' WHEN s_acctbal < 0 THEN 'unknown_area' WHEN s_acctbal <= 5000 THEN 'selected' ELSE 'excluded' END AS class
    FROM (SELECT DISTINCT l_suppkey + l_suppkey % 3 * 1000000 AS k FROM lineitem) LEFT JOIN supplier ON s_suppkey = k)
    SELECT count(*) FILTER (class = 'selected') AS selected, count(*) FILTER (class = 'unmatched') AS unmatched, count(*) FILTER (class = 'unknown_area') AS unknown_area, count(*) FILTER (class = 'excluded') AS excluded FROM j""")
def member_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members by the area of their station: four disjoint counts."""
    members = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") + F.col("l_suppkey") % 3 * 1000000).alias("key")).distinct()
    areas = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("station"), F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")).alias("area"))
    return tables.select_members(members, areas, "key", 5000.0)[1]


_NEAR = "(SELECT DISTINCT p_size FROM part)"


@query(f"""WITH t AS (SELECT s_suppkey, s_nationkey * 2.3 + 0.1 AS x FROM supplier), n AS (SELECT s_suppkey, p_size FROM t, {_NEAR} QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY abs(p_size - x), p_size) = 1)
    SELECT s_suppkey, n.p_size, count(*) AS n_rows FROM n JOIN part USING (p_size) GROUP BY ALL""")
def nearest_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a grid has at the coordinate nearest each target."""
    targets = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_nationkey") * 2.3 + 0.1).alias("x"))
    found = analysis.nearest_grid(table(spark, sf_dir, "part").select("p_size"), targets, [("p_size", "x")], n_rows=F.count("*"))
    return found.groupBy("s_suppkey", "p_size").agg(F.sum("n_rows").alias("n_rows"))


@query("""SELECT s_suppkey, CASE WHEN s_nationkey > 2 AND s_nationkey < 8 AND s_acctbal > 0 AND s_acctbal < 4000 THEN 'inner' WHEN s_nationkey > 10 AND s_nationkey < 20 AND s_acctbal > -1000.5 AND s_acctbal < 9000 THEN 'outer' END AS zone
    FROM supplier""")
def point_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The polygon that each point lies in."""
    box = lambda name, a, b, c, d: (name, [(float(a), float(c)), (float(b), float(c)), (float(b), float(d)), (float(a), float(d))])
    polygons = spark.createDataFrame([box("inner", 2.5, 7.5, 0, 4000), box("outer", 10.5, 19.5, -1000.5, 9000)], "zone string, ring array<struct<lon: double, lat: double>>")
    points = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").cast("double").alias("lon"), F.col("s_acctbal").alias("lat"))
    return analysis.point_zones(points, polygons, "s_suppkey", "lon", "lat", (1.0, 500.0))


# clocks and markers

_ZONED = "lpad(CAST(user_id AS VARCHAR), 6, '0') AS entity_id, ts, CASE user_id % 5 WHEN 0 THEN -300 WHEN 1 THEN -480 WHEN 2 THEN -240 WHEN 3 THEN -360 ELSE -210 END AS m"


@query(f"""SELECT entity_id, {_sql_text('ts')} AS local, {_sql_text('ts - to_minutes(m)')} AS utc, m * 60 AS offset_start, false AS is_transition FROM (SELECT {_ZONED} FROM events)""")
def standard_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local standard clocks to UTC, with each distinct zone and day resolved once."""
    rows = events_long(spark, sf_dir).join(recast.user_zones(spark, sf_dir), "entity_id").withColumn("day", F.to_date("time_start"))
    placed = with_standard_offsets(rows, "zone", "day")
    return placed.select("entity_id", _text("time_start", "local"), _text(shift_to_utc(F.col("time_start"), F.col("offset_start")), "utc"), "offset_start", "is_transition")


@query(f"SELECT event_id, {_sql_text('ts + INTERVAL 5 HOUR')} AS utc FROM events")
def civil_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Civil clocks of one zone to UTC; ambiguous or impossible ones would end the job."""
    return table(spark, sf_dir, "events").select("event_id", _text(civil_to_utc(F.col("ts").cast("timestamp"), "America/Toronto"), "utc"))


@query(f"""SELECT event_id, CASE WHEN floor(value) = 5 THEN CASE WHEN ts < TIMESTAMP '2024-01-15' THEN NULL ELSE 0.0 END ELSE floor(value) END AS number FROM events""")
def sentinel_eras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A marker that means missing in one era and a measured zero in the next."""
    from datetime import datetime

    turn = datetime(2024, 1, 15)
    rules = (SentinelRule("5", "missing", None, turn), SentinelRule("5", "measured_zero", turn, None))
    raw = F.floor("value").cast("long").cast("string")
    return table(spark, sf_dir, "events").select("event_id", S.apply_sentinels(raw, F.col("ts").cast("timestamp"), rules).alias("number"))


@query(f"""WITH {_EV} SELECT entity_id, {_sql_text('time_start - INTERVAL 15 MINUTE')} AS slot_start, {_sql_text('time_start')} AS slot_end FROM ev""")
def slot_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels at the end of their slots."""
    start, end = S.slot_interval(F.col("time_start"), "end", "15 minutes")
    return events_long(spark, sf_dir).select("entity_id", _text(start, "slot_start"), _text(end, "slot_end"))


@query(f"""WITH r AS (SELECT o_custkey, min(o_orderdate) AS s, max(o_orderdate) + INTERVAL 1 DAY AS e FROM orders GROUP BY 1), y AS (SELECT *, unnest(generate_series(year(s), year(e - INTERVAL 1 SECOND))) AS y FROM r)
    SELECT CAST(o_custkey AS VARCHAR) AS entity_id, {_sql_text('greatest(s, make_timestamp(y, 1, 1, 0, 0, 0))')} AS window_start, {_sql_text('least(e, make_timestamp(y + 1, 1, 1, 0, 0, 0))')} AS window_end FROM y""")
def calendar_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested ranges, split at each turn of the year."""
    at = F.col("o_orderdate").cast("timestamp")
    ranges = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("string").alias("entity_id")).agg(F.min(at).alias("start"), (F.max(at) + F.expr("INTERVAL '1' DAY")).alias("end"))
    return tables.page_windows(ranges).select("entity_id", _text("window_start"), _text("window_end"))


# scalars


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN CAST(s_suppkey AS VARCHAR) WHEN s_suppkey % 4 = 1 THEN CAST(s_suppkey AS VARCHAR) WHEN s_suppkey % 4 = 2 THEN NULL ELSE s_name END AS identifier,
    ((s_suppkey * 7 % 361) + 180) % 360 - 180.0 AS longitude FROM supplier""")
def inventory_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers as inventories write them, cleaned; longitudes of the other convention."""
    k = F.col("s_suppkey")
    raw = F.when(k % 4 == 0, F.concat(k.cast("string"), F.lit(".0"))).when(k % 4 == 1, F.concat(F.lit(" "), k.cast("string"), F.lit("  "))).when(k % 4 == 2, F.lit("   ")).otherwise(F.col("s_name"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", S.clean_identifier(raw).alias("identifier"), S.signed_longitude((k * 7 % 361).cast("double"), "0_360").alias("longitude"))


@query("""SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, count(*) FILTER (1 + o_orderkey % 31 <= day(last_day(o_orderdate))) AS real_days, count(*) AS slots FROM orders GROUP BY ALL""")
def calendar_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day slots that the month has."""
    rows = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), (F.col("o_orderkey") % 31 + 1).cast("int").alias("d"))
    real = S.is_calendar_day(F.col("y"), F.col("m"), F.col("d"))
    return rows.groupBy(F.col("y").cast("long").alias("y"), F.col("m").cast("long").alias("m")).agg(F.count_if(real).alias("real_days"), F.count("*").alias("slots"))


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS number FROM events""")
def strict_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only plain numbers parse; a type suffix makes a text no number."""
    text = F.concat(F.lit(" "), F.col("value").cast("string"), F.when(F.col("event_id") % 5 == 0, "d").otherwise(" "))
    return table(spark, sf_dir, "events").select("event_id", S.parse_number(text).alias("number"))


@query(f"SELECT c_custkey, {_BUCKET.format('CAST(c_custkey AS VARCHAR)', 16)} AS bucket FROM customer")
def entity_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", S.entity_bucket(F.col("c_custkey").cast("string"), 16).alias("bucket"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '[]' WHEN o_orderkey % 2 = 0 THEN '["' || o_orderpriority || '"]' ELSE '["' || o_orderstatus || '","' || o_orderpriority || '"]' END AS qualifiers FROM orders""")
def qualifier_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells behind the last column, blanks left out, as JSON."""
    status = F.when(F.col("o_orderkey") % 2 == 0, " ").otherwise(F.col("o_orderstatus"))
    cells = F.when(F.col("o_orderstatus") == "P", F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a"), F.lit("b"), status, F.col("o_orderpriority")))
    return table(spark, sf_dir, "orders").select("o_orderkey", S.qualifiers_json(cells, 2).alias("qualifiers"))


@query("SELECT doc_id, sha256(text) AS digest, CAST(strlen(text) AS BIGINT) AS size_bytes FROM documents")
def raw_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", S.raw_digest(F.col("text")).alias("digest"), F.octet_length("text").cast("long").alias("size_bytes"))


@query("""WITH p AS (SELECT l_orderkey, l_linenumber, l_quantity, lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity, l_extendedprice) AS q FROM lineitem)
    SELECT count(*) AS n, count(*) FILTER (round(l_quantity / 7, 1) = round(q / 7, 1)) AS same FROM p WHERE q IS NOT NULL""")
def rounded_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = F.lag("l_quantity").over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_quantity", "l_extendedprice"))
    rows = table(spark, sf_dir, "lineitem").select("l_quantity", before.alias("q")).filter("q is not null")
    return rows.agg(F.count("*").alias("n"), F.count_if(F.round(F.col("l_quantity") / 7, 1) == F.round(F.col("q") / 7, 1)).alias("same"))


# text sources


@query("""SELECT CAST(doc_id AS VARCHAR) AS source, count(*) AS n_lines, CAST(sum(length(line) * n) AS BIGINT) AS weight FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, 1 + len(string_split(text, chr(10))))) AS n, len(string_split(text, chr(10))) AS m FROM documents)
    WHERE line <> '' OR n < m GROUP BY doc_id""")
def physical_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as numbered lines."""
    lines = sources.lines_of(table(spark, sf_dir, "documents"), "doc_id", "text")
    return lines.groupBy("source").agg(F.count("*").alias("n_lines"), F.sum(F.char_length("raw") * F.col("line_number")).alias("weight"))


_ARCHIVE = """d AS (SELECT user_id, date_trunc('day', ts) AS day FROM events GROUP BY ALL), h AS (SELECT user_id, day, unnest(range(24)) AS h FROM d),
    s AS (SELECT h.user_id, day, h, count(e.event_id) AS n FROM h LEFT JOIN events e ON e.user_id = h.user_id AND date_trunc('day', e.ts) = day AND hour(e.ts) = h GROUP BY ALL)"""


@query(f"""WITH {_ARCHIVE} SELECT lpad(CAST(user_id AS VARCHAR), 7, '0') AS entity_id, {_sql_text("day + to_hours(CAST(h AS INTEGER)) - to_minutes(CASE user_id % 5 WHEN 0 THEN -300 WHEN 1 THEN -480 WHEN 2 THEN -240 WHEN 3 THEN -360 ELSE -210 END)")} AS time_start,
    n * 0.1::DOUBLE AS value FROM s WHERE user_id % 11 <> 2""")
def hourly_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed-width hourly records, damaged ones among them, to UTC hours."""
    parsed = fixed_width.parse_hourly(recast.hourly_archive(spark, sf_dir), fixed_width.check_zones(recast.user_zones(spark, sf_dir, 7)), recast.COUNTS, "salvage")
    return parsed.accepted.select("entity_id", _text("time_start"), "value")


@query("""WITH d AS (SELECT user_id, date_trunc('day', ts) AS day FROM events GROUP BY ALL)
    SELECT CASE user_id % 11 WHEN 2 THEN 'truncated_fixed_width_record' ELSE 'extra_bytes_around_valid_fixed_width_records' END AS reason, count(*) AS n_lines, CAST(sum(CASE user_id % 11 WHEN 2 THEN 0 ELSE 1 END) AS BIGINT) AS recovered FROM d WHERE user_id % 11 IN (2, 4, 5) GROUP BY 1""")
def rejection_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archive lost, by reason."""
    lost = fixed_width.route_lines(recast.hourly_archive(spark, sf_dir), fixed_width.HOURLY, recast.COUNTS, "salvage")[1]
    return lost.groupBy("reason").agg(F.count("*").alias("n_lines"), F.sum("recovered_count").alias("recovered"))


@query("""WITH d AS (SELECT user_id, date_trunc('day', ts) AS day FROM events GROUP BY ALL)
    SELECT count(*) AS physical, count(*) FILTER (user_id % 11 <> 2) AS records, count(*) FILTER (user_id % 11 IN (2, 4, 5)) AS rejected, count(*) FILTER (user_id % 11 IN (4, 5)) AS recovered, true AS balanced FROM d""")
def archive_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every physical line is a record, or rejected, or both when records were taken out of it."""
    lines = recast.hourly_archive(spark, sf_dir)
    records, lost = fixed_width.route_lines(lines, fixed_width.HOURLY, recast.COUNTS, "salvage")
    return gates.accounting(lines, records, lost)


_MONTHS = """m AS (SELECT DISTINCT o_custkey, date_trunc('month', o_orderdate) AS month FROM orders), s AS (SELECT o_custkey, unnest(generate_series(CAST(month AS TIMESTAMP), CAST(last_day(month) AS TIMESTAMP), INTERVAL 1 DAY)) AS day FROM m),
    o AS (SELECT s.o_custkey, s.day, count(o_orderkey) AS n, coalesce(max(CASE WHEN o_orderstatus = 'P' THEN 'P' END), '') AS flag FROM s LEFT JOIN orders x ON x.o_custkey = s.o_custkey AND x.o_orderdate = s.day GROUP BY ALL)"""


@query(f"""WITH {_MONTHS} SELECT lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS entity_id, {_sql_text("day + CASE WHEN day < TIMESTAMP '1998-01-01' THEN INTERVAL 6 HOUR ELSE INTERVAL 12 HOUR END")} AS time_start, n::DOUBLE AS value, flag AS quality_flag FROM o""")
def daily_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly records to climatological days, whose boundary depends on the era."""
    parsed = fixed_width.parse_daily(recast.monthly_archive(spark, sf_dir), recast.ORDER_COUNTS, recast.DAY_ERAS)
    return parsed.accepted.select("entity_id", _text("time_start"), "value", "quality_flag")


@query(f"""WITH {_MONTHS} SELECT lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS entity_id, {_sql_text('day + INTERVAL 6 HOUR')} AS time_start, {_sql_text('day + INTERVAL 30 HOUR')} AS time_end, n::DOUBLE AS orders, flag AS orders_quality FROM o""")
def month_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """31 columns a month to days of a zone without daylight saving."""
    accepted = tables.parse_month_matrix(recast.order_months(spark, sf_dir), "America/Regina", "orders").accepted
    return accepted.select("entity_id", _text("time_start"), _text("time_end"), "orders", "orders_quality")


@query("SELECT s_suppkey, s_name AS name, s_acctbal AS balance FROM supplier")
def headed_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV whose header stands behind disclaimer lines, read as text and typed."""
    suppliers = table(spark, sf_dir, "supplier")
    text = F.concat_ws(",", F.concat(F.lit('"'), F.col("s_suppkey").cast("string"), F.lit('.0"')), "s_name", F.col("s_acctbal").cast("string"))
    body = suppliers.groupBy(F.expr("s_suppkey div 500").alias("block")).agg(F.array_join(F.sort_array(F.collect_list(text)), "\n").alias("rows"))
    files = body.select(F.col("block").cast("string").alias("source"), F.concat(F.lit("Disclaimer\n,,\n\nStation ID,Name,Balance\n"), "rows", F.lit("\n")).alias("text"))
    cells = sources.named_cells(sources.headed_csv(sources.lines_of(files, "source", "text"), "Station ID", 3), ["Station ID", "Name", "Balance"])
    found = tables.parse_inventory(cells, {"entity_id": "Station ID", "name": "Name", "balance": "Balance"}, ["balance"])
    return found.select(F.col("entity_id").cast("long").alias("s_suppkey"), "name", "balance")


@query(f"""SELECT lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS entity_id, {_sql_text('o_orderdate')} AS time_start, o_totalprice AS value, CASE WHEN o_orderstatus = 'P' THEN 'Provisional' ELSE 'Approved' END AS approval,
    CASE WHEN o_orderkey % 3 = 0 THEN '[]' ELSE '["' || o_orderpriority || '"]' END AS qualifiers FROM orders""")
def unit_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with a commented preamble, an exact header and qualifiers behind the last column."""
    o = table(spark, sf_dir, "orders")
    line = F.concat_ws(",", F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00'Z'"), F.lit("local"), F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.when(F.col("o_orderstatus") == "P", "Provisional").otherwise("Approved"), F.lit("20"), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderpriority")))
    body = o.groupBy("o_custkey").agg(F.array_join(F.collect_list(line), "\n").alias("rows"))  # a customer's orders make one file
    head = F.concat(F.lit("# Station: "), F.lpad(F.col("o_custkey").cast("string"), 7, "0"), F.lit("\n# Unit: USD\nUTC, Local, Value, Approval, Grade, Qualifiers\n"))
    files = body.select(F.col("o_custkey").cast("string").alias("source"), F.concat(head, "rows", F.lit("\n,,,,,\n")).alias("text"))
    rows = sources.commented_csv(sources.lines_of(files, "source", "text"), ["UTC", "Local", "Value", "Approval", "Grade", "Qualifiers"], ["Station", "Unit"], 8)
    return tables.parse_unit_values(rows, F.col("metadata")["Station"]).select("entity_id", _text("time_start"), "value", "approval", "qualifiers")


@query("SELECT o_orderkey, CAST(o_custkey * 10 AS BIGINT) AS matched FROM orders")
def hits_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts out of count responses."""
    body = F.concat(F.lit('{"type":"FeatureCollection","features":[],"numberMatched":'), (F.col("o_custkey") * 10).cast("string"), F.lit("}"))
    return table(spark, sf_dir, "orders").select("o_orderkey", sources.hits_count(body).alias("matched"))


_PAGE_SQL = f"SELECT {_ZONED}, event_id FROM events"


@query(f"""SELECT event_id, entity_id, {_sql_text("date_trunc('minute', ts) - INTERVAL 1 HOUR - to_minutes(m)")} AS time_start, {_sql_text("date_trunc('minute', ts) - to_minutes(m)")} AS time_end FROM ({_PAGE_SQL})""")
def api_page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of CSV with an exact header to UTC intervals, checked against the publisher's own instant."""
    e = table(spark, sf_dir, "events").join(recast.user_zones(spark, sf_dir), F.lpad(F.col("user_id").cast("string"), 6, "0") == F.col("entity_id"))
    offset = F.get(F.array(*(F.lit(int(h * 60)) for _, h in recast.ZONES)), (F.col("user_id") % 5).cast("int"))
    local = F.date_trunc("minute", F.col("ts").cast("timestamp"))
    line = F.concat_ws(",", "entity_id", F.date_format(local, "yyyy-MM-dd HH:mm:ss"), F.date_format(shift_to_utc(local, offset * 60), "yyyy-MM-dd HH:mm:ss"), F.col("event_id").cast("string"))
    body = e.groupBy("user_id", F.to_date("ts")).agg(F.array_join(F.collect_list(line), "\r\n").alias("rows"))  # a page a user and day
    pages = body.select(F.concat(F.lit("page"), F.col("user_id").cast("string")).alias("source"), F.concat(F.lit("STATION,LOCAL_DATE,UTC_DATE,ID\r\n"), "rows", F.lit("\r\n")).alias("body"))
    rows = sources.api_pages(pages, ["STATION", "LOCAL_DATE", "UTC_DATE", "ID"]).withColumn("local", F.to_timestamp("LOCAL_DATE", "yyyy-MM-dd HH:mm:ss")).withColumnRenamed("STATION", "entity_id")
    placed = tables.place_page_rows(rows, recast.user_zones(spark, sf_dir), publisher_utc="UTC_DATE").accepted
    return placed.select(F.col("ID").cast("long").alias("event_id"), "entity_id", _text("time_start"), _text("time_end"))


@query(f"""WITH p AS (SELECT *, regexp_extract(url, '^https?://([^/]+)', 1) AS host FROM pages) SELECT host, count(*) AS n_rows, count(*) FILTER (length(html) > 5000) AS n_published, count(*) FILTER (NOT length(html) > 5000) AS n_set_aside,
    min(page_id) AS first_day, max(page_id) AS last_day, count(*) FILTER (trim(url) <> '') AS url_count, count(DISTINCT url) <= 1 AS url_constant FROM p GROUP BY host""")
def page_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").withColumn("host", F.regexp_extract("url", r"^https?://([^/]+)", 1))
    return tables.page_profile(pages, "host", F.char_length("html") > 5000, "page_id", ["url"], ["url"])


@query("""WITH w AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) SELECT o_custkey AS climate_id, CAST(n AS BIGINT) AS matched, CAST(ceil(n / 5.0) AS BIGINT) - CASE WHEN o_custkey % 7 = 0 THEN 1 ELSE 0 END AS n_pages,
    CASE WHEN o_custkey % 7 = 0 THEN 'pages_incomplete' END AS fault FROM w""")
def manifest_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows whose pages don't add up to the published count: here every seventh lacks its last page."""
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("climate_id")).agg(F.count("*").alias("n"))
    pages = n.withColumn("page_offset", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(5).cast("long"))))
    kept = pages.filter(~((F.col("climate_id") % 7 == 0) & (F.col("page_offset") + 5 >= F.col("n"))))
    rows = kept.select("climate_id", F.lit("page").alias("role"), "page_offset", F.col("n").alias("number_matched"))
    manifest = rows.unionByName(n.select("climate_id", F.lit("hits").alias("role"), F.lit(None).cast("long").alias("page_offset"), F.col("n").alias("number_matched"))).withColumn("window_start", F.lit("all"))
    return tables.check_manifest(manifest, 5).select("climate_id", "matched", "n_pages", "fault")


@query("""WITH r AS (SELECT sha256('{"c_custkey":' || CAST(c_custkey AS VARCHAR) || ',"c_mktsegment":"' || c_mktsegment || '"}') AS d FROM customer), p AS (SELECT substr(d, 1, 2) AS lead, sha256(string_agg(d, ',' ORDER BY d)) AS g FROM r GROUP BY 1)
    SELECT sha256(string_agg(g, ',' ORDER BY lead) || '|{"limit": 10}') AS fingerprint FROM p""")
def selection_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One digest of the member rows, in whatever order they come."""
    return tables.selection_fingerprint(table(spark, sf_dir, "customer"), ["c_custkey", "c_mktsegment"], {"limit": 10})


# metadata and snapshots


@query("""WITH RECURSIVE e AS (SELECT s_suppkey AS c, s_suppkey // 2 AS p FROM supplier WHERE s_suppkey > 0 UNION SELECT s_suppkey, s_suppkey // 3 FROM supplier WHERE s_suppkey > 0),
    a AS (SELECT max(s_suppkey) AS k FROM supplier UNION SELECT p FROM a JOIN e ON c = k) SELECT CAST(k AS VARCHAR) AS snapshot_id FROM a""")
def lineage_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ancestors in a graph whose nodes have two parents each."""
    s = table(spark, sf_dir, "supplier").filter("s_suppkey > 0")
    step = lambda d: s.select(F.col("s_suppkey").cast("string").alias("snapshot_id"), F.expr(f"cast(s_suppkey div {d} as string)").alias("parent_snapshot_id"))
    roots = table(spark, sf_dir, "supplier").agg(F.max("s_suppkey").cast("string").alias("snapshot_id"))
    return closure(step(2).unionByName(step(3)), roots).select("snapshot_id")


@query("""SELECT CAST(user_id AS VARCHAR) AS source_id, event_type AS original_name FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type) = 1""")
def preferred_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One name a source: a publisher's before a digest, then the earliest."""
    rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("source_id"), F.col("event_type").alias("original_name"), F.col("ts").alias("recorded_at"))
    return preferred_names(rows)


@query("SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM (SELECT o_custkey, o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS r FROM orders) WHERE r = 1 GROUP BY 1")
def live_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest record of each entity."""
    return analysis.newest(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", ["o_orderkey"])


@query("SELECT o_orderkey, o_totalprice, NULL::VARCHAR AS note FROM orders WHERE year(o_orderdate) < 1998 UNION ALL SELECT o_orderkey, NULL, o_orderpriority FROM orders WHERE year(o_orderdate) >= 1998")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments with different columns as one table."""
    o = table(spark, sf_dir, "orders")
    old, new = o.filter(F.year("o_orderdate") < 1998), o.filter(F.year("o_orderdate") >= 1998)
    return old.select("o_orderkey", "o_totalprice").unionByName(new.select(F.col("o_orderpriority").alias("note"), "o_orderkey"), allowMissingColumns=True)


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").groupBy(F.lpad(F.col("o_custkey").cast("string"), 7, "0").alias("entity_id"), at.alias("time_start"), (at + F.expr("INTERVAL '1' DAY")).alias("time_end")).agg(F.max("o_totalprice").alias("total"))


_ORDER_DAYS = f"SELECT lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS entity_id, {_sql_text('o_orderdate')} AS time_start, max(o_totalprice) AS total FROM orders WHERE {{}} GROUP BY o_custkey, o_orderdate"


@query(_ORDER_DAYS.format("o_orderdate >= TIMESTAMP '1996-06-01' AND o_orderdate < TIMESTAMP '1999-01-01'"))
def appended_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appended snapshots, gated and published, read back as one over a stretch of time."""
    store = Store(spark, shared_path(spark, "store"), Registry([recast.ORDERS]))
    days = _order_days(spark, sf_dir)
    store.publish(days.filter(F.year("time_start") < 1998), "orders_daily", "first", "1")
    store.publish(days.filter(F.year("time_start") >= 1998), "orders_daily", "second", "1")
    return store.load("orders_daily", start="1996-06", end="1999").select("entity_id", _text("time_start"), "total")


@query(_ORDER_DAYS.format("o_orderdate < TIMESTAMP '1997-01-01'"))
def time_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replaced snapshot, read by its id."""
    store = Store(spark, shared_path(spark, "store"), Registry([recast.LATEST_ORDERS]))
    days = _order_days(spark, sf_dir)
    first = store.publish(days.filter(F.year("time_start") < 1997), "orders_latest", "first", "1")
    store.publish(days.filter(F.year("time_start") >= 1997), "orders_latest", "second", "1")
    return store.load("orders_latest", snapshot=first).select("entity_id", _text("time_start"), "total")
