"""The driver's tables as observation data: events as long observations, text archives made from counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.plans.fixed_width import DayEra, Element
from tideglass.spec import DatasetSpec, PlausibilityBand, VariableSpec

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
EVENTS = DatasetSpec(
    "events_long", variables=tuple(VariableSpec(t, "1", band=PlausibilityBand(0.5, 0, 1e6, "amounts seen so far")) for t in EVENT_TYPES), documentation="one row an event, ten minutes long",
)
ORDERS = DatasetSpec("orders_daily", storage="wide", mode="append", variables=(VariableSpec("total", "USD"),))
LATEST_ORDERS = DatasetSpec("orders_latest", storage="wide", mode="replace", variables=(VariableSpec("total", "USD"),))
YEARLY_ORDERS = DatasetSpec("orders_yearly", storage="wide", mode="replace", variables=(VariableSpec("total", "USD"),))
#: Zones by key modulo 5, with their standard offsets in hours (January 2024).
ZONES = (("America/Toronto", -5), ("America/Vancouver", -8), ("America/Halifax", -4), ("America/Regina", -6), ("America/St_Johns", -3.5))
COUNTS = (Element("123", "events", 0.1, 60, start_minute=0),)
ORDER_COUNTS = (Element("001", "orders", 1.0, start_minute=0),)
DAY_ERAS = (DayEra("1990-01-01", "1998-01-01", 6), DayEra("1998-01-01", None, 12))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, time_start, time_end, variable, value."""
    e = table(spark, sf_dir, "events")
    at = F.col("ts").cast("timestamp")
    return e.select(F.lpad(F.col("user_id").cast("string"), 6, "0").alias("entity_id"), at.alias("time_start"), (at + F.expr("INTERVAL '10' MINUTE")).alias("time_end"), F.col("event_type").alias("variable"), "value")


def user_zones(spark: SparkSession, sf_dir: str, width: int = 6) -> DataFrame:
    """(entity_id, zone) of the users."""
    zone = F.get(F.array(*(F.lit(z) for z, _ in ZONES)), (F.col("user_id") % 5).cast("int"))
    return table(spark, sf_dir, "events").select(F.lpad(F.col("user_id").cast("string"), width, "0").alias("entity_id"), zone.alias("zone")).distinct()


def hourly_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, line_number, raw): a record for each user and day, its slots the events of the hours.

    By the user's number modulo 11, lines are short of their last flag (1), truncated (2), followed by blanks (3) or by
    rubbish (4), or preceded by two characters too many (5).
    """
    e = table(spark, sf_dir, "events")
    by_hour = e.groupBy("user_id", F.to_date("ts").alias("day"), F.hour("ts").alias("h")).agg(F.count("*").alias("n"))
    days = by_hour.groupBy("user_id", "day").agg(F.map_from_entries(F.collect_list(F.struct("h", "n"))).alias("m"))
    slot = F.expr("array_join(transform(sequence(0, 23), h -> concat(lpad(cast(coalesce(m[h], 0) as string), 6, ' '), ' ')), '')")
    record = F.concat(F.lpad(F.col("user_id").cast("string"), 7, "0"), F.date_format("day", "yyyyMMdd"), F.lit("123"), slot)
    k = F.col("user_id") % 11
    raw = F.when(k == 1, F.expr("substring(r, 1, 185)")).when(k == 2, F.expr("substring(r, 1, 100)")).when(k == 3, F.concat("r", F.lit("    "))).when(k == 4, F.concat("r", F.lit("RUBBISH"))).when(k == 5, F.concat(F.lit("##"), F.col("r"))).otherwise(F.col("r"))
    lines = days.select("user_id", "day", record.alias("r")).select(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("source"), "day", raw.alias("raw"))
    from tideglass.sources.lines import numbered

    return numbered(lines.withColumn("block_start", F.lit(0)), order="day").select("source", "line_number", "raw")


def _month_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(station, year, month, m): of a customer's month the days with orders, m giving their number n and whether one is open.

    A day's orders are summed up before they meet their month, so a month's map has 31 entries at most.
    """
    o = table(spark, sf_dir, "orders")
    days = o.groupBy("o_custkey", F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"), F.max(F.col("o_orderstatus").eqNullSafe("P")).alias("open"))
    entry = F.struct(F.coalesce(F.dayofmonth("day"), F.lit(0)), F.struct("n", "open"))
    months = days.groupBy("o_custkey", F.year("day").alias("year"), F.month("day").alias("month")).agg(F.map_from_entries(F.collect_list(entry)).alias("m"))
    return months.select(F.lpad(F.col("o_custkey").cast("string"), 7, "0").alias("station"), "year", "month", "m")


def order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(station, year, month, value1 .. value31, flag1 .. flag31): a customer's orders by day of a month, P flagging days with open ones."""
    # lambdas keep the generated code short: methods beyond 8000 bytes are never compiled
    slots = F.expr("transform(sequence(1, 31), d -> struct(cast(coalesce(m[d].n, 0) as double) as n, if(m[d].open, 'P', null) as flag))")
    made = _month_days(spark, sf_dir).select("station", "year", "month", slots.alias("s"))
    named = [x for d in range(31) for x in (F.get("s", F.lit(d))["n"].alias(f"value{d + 1}"), F.get("s", F.lit(d))["flag"].alias(f"flag{d + 1}"))]
    return made.select("station", "year", "month", *named)


def monthly_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, line_number, raw): a customer's orders by day of a month as monthly records, P flagging days with open ones."""
    slots = F.expr("array_join(transform(sequence(1, 31), d -> concat(lpad(cast(coalesce(m[d].n, 0) as string), 6, ' '), if(m[d].open, 'P', ' '))), '')")
    raw = F.concat("station", F.col("year").cast("string"), F.lpad(F.col("month").cast("string"), 2, "0"), F.lit("001"), slots)
    return _month_days(spark, sf_dir).select(F.lit("orders").alias("source"), F.lit(1).cast("long").alias("line_number"), raw.alias("raw"))
