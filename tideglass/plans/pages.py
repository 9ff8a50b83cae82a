"""The collection of API pages as one job: pages are parsed once, on their way into one table; all gates read that.

What has to hold for single rows is counted while the table is written; what has to hold for pages and windows is summed
up from the table, a row a page. Nothing is returned unless all of it holds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tideglass.operators.gates import GateError
from tideglass.plans import tables
from tideglass.plans.result import ParseResult
from tideglass.session import kept
from tideglass.sources.lines import api_pages
from tideglass.spec import DeclarationError


@dataclass(frozen=True)
class PageLayout:
    """How a publisher's pages look: the exact header, and which columns mean what."""

    columns: Sequence[str]
    station: str
    local: str
    publisher_utc: str | None = None
    parts: Sequence[str] = ()
    key: str | None = None
    constants: Sequence[str] = ()
    numbers: Sequence[str] = ()
    markers: Mapping[str, Sequence[str]] = field(default_factory=dict)
    flags: Sequence[str] = ()
    duration: str = "1 hour"

    def __post_init__(self):
        known, problems = {*self.columns}, []
        if len(known) != len(self.columns):
            problems.append("a column is named twice")
        named = [self.station, self.local, *filter(None, (self.publisher_utc, self.key)), *self.parts, *self.constants, *self.numbers, *self.flags]
        problems += [f"no column {c}" for c in named if c not in known]
        if self.parts and len(self.parts) != 4:
            problems.append("parts are year, month, day and hour")
        problems += [f"marker {m} is for {c}, which is no number" for m, own in self.markers.items() for c in own if c not in self.numbers]
        if {*self.numbers} & {*self.flags, *self.constants, *self.parts}:
            problems.append("a number is a flag, a constant or a part of the clock as well")
        if problems:
            raise DeclarationError("page layout: " + "; ".join(problems))


@dataclass(frozen=True)
class Collected:
    """A collection that passed its gates.

    result: published and set aside rows; accounts: a row a page; flags: counted values of the flag columns; record: one
    row on the whole; metrics: what was counted while the rows were written.
    """

    result: ParseResult
    accounts: DataFrame
    flags: DataFrame
    record: DataFrame
    metrics: dict


def collect_pages(pages: DataFrame, counts: DataFrame, zones: DataFrame, layout: PageLayout) -> Collected:
    """Parses and checks all pages of all windows in one job.

    pages: (source, body). counts: (source, climate_id, window_start, window_end, matched), the window that each page
    belongs to and the number of rows published for the window. A page that no count names, a row with a fault, a column
    that varies within a page, and a window with other than the published number of rows end the job, with up to three
    examples; the pages themselves are read once.
    """
    rows = api_pages(pages, layout.columns).withColumnsRenamed({layout.station: "station_id", layout.local: "local_date"})
    windows = counts.select("source", "climate_id", "window_start", "window_end", F.lit(True).alias("_known"))
    checked = tables.check_page_rows(rows.join(windows, "source", "left"), parts=layout.parts, key=layout.key)
    checked = checked.withColumn("fault", F.when(F.col("_known").isNull(), "page_without_count").otherwise(F.col("fault"))).drop("_known")
    fine = {c: F.when(F.col("fault").isNull(), F.col(c)) for c in layout.numbers}  # of a row with a fault no cell is read
    typed = tables.scoped_values(checked.withColumns(fine), layout.numbers, layout.markers).withColumnRenamed("station_id", "entity_id")
    placed = tables.placed_rows(typed, zones, layout.duration, layout.publisher_utc)
    where = F.concat_ws(" ", "source", F.lit("row"), F.col("row_number").cast("string"), "fault")
    seen = Observation()
    counted = placed.observe(
        seen, F.count("*").alias("rows"), F.count("fault").alias("faults"), F.min(F.when(F.col("fault").isNotNull(), where)).alias("first_fault"), F.max(F.when(F.col("fault").isNotNull(), where)).alias("last_fault"),
        F.count_if(F.col("fault").isNull() & F.col("reason").isNotNull()).alias("set_aside"), F.min("time_start").alias("first"), F.max("time_end").alias("last"),
    )
    staged = kept(counted, "pages")
    metrics = seen.get
    if metrics["faults"]:
        raise GateError(f"{metrics['faults']} rows have faults: {sorted({metrics['first_fault'], metrics['last_fault']})}")
    name = {layout.station: "entity_id", layout.local: "local_date"}
    constants = [name.get(c, c) for c in layout.constants]
    # a page's rows by reason, then the page
    by_reason = staged.groupBy("source", "climate_id", "window_start", "reason").agg(F.count("*").alias("n"), *(f(c).alias(f"_{k}_{c}") for c in constants for k, f in (("least", F.min), ("most", F.max))))
    whole = by_reason.groupBy("source", "climate_id", "window_start").agg(
        F.sum("n").alias("physical"), F.coalesce(F.sum(F.when(F.col("reason").isNull(), F.col("n"))), F.lit(0)).alias("published"), F.coalesce(F.sum(F.when(F.col("reason").isNotNull(), F.col("n"))), F.lit(0)).alias("set_aside"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("reason").isNotNull(), F.concat_ws(":", "reason", F.col("n").cast("string"))))), ",").alias("reasons"),
        *((~F.min(f"_least_{c}").eqNullSafe(F.max(f"_most_{c}"))).alias(f"_varies_{c}") for c in constants),
    )
    per_page = kept(whole, "page-accounts")
    if constants and (bad := per_page.filter(" OR ".join(f"`_varies_{c}`" for c in constants)).select("source", *(f"_varies_{c}" for c in constants)).limit(3).collect()):
        raise GateError(f"columns vary within pages: {[r.asDict() for r in bad]}")
    keys = ["climate_id", "window_start"]
    published = counts.groupBy(*keys).agg(F.max("matched").alias("matched"), F.min("matched").alias("_least"), F.max("window_end").alias("window_end"), F.count_distinct("source").alias("pages"))
    got = published.join(per_page.groupBy(*keys).agg(F.sum("physical").alias("n_rows"), F.sum("published").alias("published"), F.sum("set_aside").alias("set_aside")), keys, "left").fillna(0, ["n_rows", "published", "set_aside"])
    if bad := got.filter("matched <> n_rows OR matched <> _least").select(*keys, "matched", "n_rows").limit(3).collect():
        raise GateError(f"pages and counts differ: {[tuple(map(str, r)) for r in bad]}")
    record = got.agg(
        F.count_distinct("climate_id").alias("stations"), F.min("window_start").alias("first_window"), F.max("window_end").alias("last_window"), F.count("*").alias("windows"), F.sum("pages").alias("pages"),
        F.sum("matched").alias("matched"), F.sum("published").alias("published"), F.sum("set_aside").alias("set_aside"), F.count_if(F.col("n_rows") == 0).alias("empty_windows"),
    )
    accounts = per_page.select("source", "physical", "published", "set_aside", "reasons", (F.col("physical") == F.col("published") + F.col("set_aside")).alias("balanced"))
    flags = tables.value_counts(staged, "source", layout.flags) if layout.flags else None
    return Collected(tables.split_by_reason(staged.drop("fault")), accounts, flags, record, metrics)
