"""Snapshots: gates, append, replace, time travel, lineage, audit."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tideglass import recast
from tideglass.operators.gates import GateError, band_quantiles, check_plausible
from tideglass.operators.views import guarded_pivot, normalized_variables
from tideglass.plans import tables
from tideglass.spec import DatasetSpec, DeclarationError, PlausibilityBand, Registry, VariableSpec
from tideglass.store import Store, StoreError

LONG = DatasetSpec("long", variables=(VariableSpec("rain", "mm"), VariableSpec("temperature", "degC", quality_field="temperature_quality")))
WIDE = DatasetSpec("wide", storage="wide", variables=(VariableSpec("power", "kW"),))
LATEST = DatasetSpec("latest", storage="wide", mode="replace", variables=(VariableSpec("power", "kW"),))
DERIVED = DatasetSpec("mean_power", storage="wide", mode="replace", variables=(VariableSpec("mean_power", "kW"),))
HOUR = timedelta(hours=1)


def long_rows(spark, rows):
    return spark.createDataFrame([(e, t, t + HOUR, v, x, f) for e, t, v, x, f in rows], "entity_id string, time_start timestamp, time_end timestamp, variable string, value double, quality_flag string")


def wide_rows(spark, *rows):
    return spark.createDataFrame([(e, t, t + HOUR, x) for e, t, x in rows], "entity_id string, time_start timestamp, time_end timestamp, power double")


@pytest.fixture()
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"), Registry([LONG, WIDE, LATEST, DERIVED]))


def test_long_round_trip(spark, store):
    t = datetime(2024, 1, 1)
    rows = long_rows(spark, [("0100001", t, "rain", 1.0, None), ("0100001", t + HOUR, "rain", 2.0, None), ("702S006", t, "temperature", -5.0, "E")])
    first = store.publish(rows, "long", "src", "1")
    assert store.publish(rows, "long", "src", "1") == first
    found = store.load("long", entity="702S006").collect()
    assert [(r.rain, r.temperature, r.temperature_quality) for r in found] == [(None, -5.0, "E")]
    assert store.load("long", entity=[]).count() == 3
    assert store.load("long", variable="rain", start="2024-01-01T01:00", limit=1).first().rain == 2.0
    assert store.collect("long", limit=1).shape[0] == 1
    with pytest.raises(StoreError):
        store.collect("long", max_rows=2)
    assert "long" in store.connect() and spark.sql("SELECT count(*) FROM long").first()[0] == 3
    assert store.audit().filter("severity = 'error'").count() == 0
    assert store.provenance("long").count() == 1
    assert store.runs_behind("long").first().n_fragments >= 1


def test_gates(spark, store):
    t = datetime(2024, 1, 1)
    with pytest.raises(GateError, match="repeated"):
        store.publish(wide_rows(spark, ("a", t, 1.0), ("a", t, 2.0)), "wide", "x", "1")
    with pytest.raises(StoreError):
        store.load("wide")
    store.publish(wide_rows(spark, ("a", t, 1.0)), "wide", "y", "1")
    with pytest.raises(GateError, match="published before"):
        store.publish(wide_rows(spark, ("a", t, 3.0)), "wide", "z", "1")
    assert {r.state for r in store.runs().filter("source_id in ('x', 'z')").collect()} == {"failed"}
    with pytest.raises(GateError, match="undeclared"):
        store.publish(wide_rows(spark, ("b", t, 1.0)).withColumnRenamed("power", "other"), "wide", "w", "1")
    pivot = long_rows(spark, [("a", t, "rain", 1.0, None), ("a", t, "rain", 1.0, None)])
    with pytest.raises(Exception, match="occurs twice"):
        guarded_pivot(pivot, LONG, ["rain"]).collect()


def test_append_replace_supersede(spark, store):
    a, b = wide_rows(spark, ("a", datetime(2023, 1, 1), 1.0)), wide_rows(spark, ("a", datetime(2024, 1, 1), 3.0))
    store.publish(a, "wide", "1", "1")
    store.publish(b, "wide", "2", "1")
    assert sorted(r.power for r in store.load("wide").collect()) == [1.0, 3.0]
    assert [r.power for r in store.load("wide", start="2023", end="2024").collect()] == [1.0]
    first = store.publish(a, "latest", "1", "1")
    store.publish(b, "latest", "2", "1")
    assert [r.power for r in store.load("latest").collect()] == [3.0]
    assert [r.power for r in store.load("latest", snapshot=first).collect()] == [1.0]
    assert store.supersede("wide", "tests are over") == 2
    with pytest.raises(StoreError):
        store.load("wide")


def test_derived(spark, store):
    parent = store.publish(wide_rows(spark, ("a", datetime(2023, 1, 1), 1.0), ("a", datetime(2023, 1, 1, 1), 3.0)), "wide", "1", "1")
    make = lambda s, parents: parents[0].groupBy("entity_id").agg({"power": "avg", "time_start": "min", "time_end": "max"}).selectExpr("entity_id", "`min(time_start)` AS time_start", "`max(time_end)` AS time_end", "`avg(power)` AS mean_power")
    made = store.materialize("mean_power", [parent], {"mean": "power"}, "1", make)
    assert store.load("mean_power").first().mean_power == 2.0
    assert {r.snapshot_id for r in store.lineage(made).collect()} == {made, parent}
    assert store.provenance("mean_power").count() == 2
    with pytest.raises(StoreError):
        store.materialize("mean_power", ["nothing"], {}, "1", make)


@pytest.mark.parametrize("values, fits", [([100.0 * h for h in range(23)], False), ([float(h) for h in range(22)] + [99999.0], True), ([], True)])
def test_plausibility(spark, values, fits):
    spec = DatasetSpec("snow", variables=(VariableSpec("depth", "cm", band=PlausibilityBand(0.5, 0, 300, "records")),))
    rows = long_rows(spark, [("a", datetime(2024, 1, 1) + HOUR * k, "depth", v, None) for k, v in enumerate(values)])
    assert band_quantiles(rows, spec).count() == (1 if values else 0)
    if fits:
        check_plausible(rows, spec)
    else:
        with pytest.raises(GateError):
            check_plausible(rows, spec)


def test_declarations():
    with pytest.raises(DeclarationError):
        Registry([WIDE, WIDE])
    with pytest.raises(DeclarationError, match="known"):
        Registry([WIDE]).get("other")
    with pytest.raises(DeclarationError):
        normalized_variables(LONG, ["rain", "rain"])
    with pytest.raises(DeclarationError):
        normalized_variables(LONG, [])
    with pytest.raises(DeclarationError):
        DatasetSpec("x", ready=False).require_ready()
    refined = Registry([WIDE]).overlay('{"wide": {"timezone": "America/Toronto"}}')
    assert refined.get("wide").timezone == "America/Toronto" and refined.get("wide").digest() != WIDE.digest()
    with pytest.raises(DeclarationError):
        Registry([WIDE]).overlay('{"wide": {"variables": []}}')


def test_file_stream(spark, tmp_path):
    from tideglass.streaming.files import ingest_new_files

    (tmp_path / "in").mkdir()
    seen = []
    handle = lambda df, n: seen.extend((r.line_number, r.raw) for r in df.collect())
    (tmp_path / "in" / "a.txt").write_text("one\ntwo\n")
    ingest_new_files(spark, str(tmp_path / "in"), str(tmp_path / "cp"), handle)
    (tmp_path / "in" / "b.txt").write_text("three\n")
    ingest_new_files(spark, str(tmp_path / "in"), str(tmp_path / "cp"), handle)
    assert sorted(seen) == [(1, "one"), (1, "three"), (2, "two")]


def test_sources(spark, store, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.csv").write_text("1")
    (tmp_path / "x" / "b.csv").write_text("1")
    assert store.register_sources(str(tmp_path / "x")).select("source_id").distinct().count() == 1
    store.register_sources(str(tmp_path / "x"))
    assert store.meta("source_files").count() == 1 and store.meta("source_aliases").count() == 2


def test_closure_stays_off_the_driver(spark, monkeypatch):
    from pyspark.sql import DataFrame

    from tideglass.store import closure

    edges = spark.createDataFrame([("d", "b"), ("d", "c"), ("b", "a"), ("c", "a"), ("a", None), ("x", "y"), ("a", "d")], "snapshot_id string, parent_snapshot_id string")
    with monkeypatch.context() as m:
        m.setattr(type(edges), "collect", lambda self: pytest.fail("collected"))
        found = closure(edges, spark.createDataFrame([("d",)], "snapshot_id string"))
    assert isinstance(found, DataFrame) and {tuple(r) for r in found.collect()} == {("d", 0), ("b", 1), ("c", 1), ("a", 2)}
    chain = spark.range(12).selectExpr("string(id) AS snapshot_id", "string(id + 1) AS parent_snapshot_id")
    assert closure(chain, spark.createDataFrame([("0",)], "snapshot_id string")).agg({"depth": "max"}).first()[0] == 12


def test_rejections_of_a_run_are_one_set(spark, store):
    from pyspark.sql import functions as F

    from tideglass.plans.tables import rejection

    lost = lambda *rows: spark.createDataFrame([*rows], "line int, why string").select(*rejection(F.lit("f"), F.concat(F.lit("line:"), F.col("line").cast("string")), F.lit("row"), F.col("why"), F.lit("raw"), F.lit(0), F.struct("line")))
    store.record_rejections("r1", "wide", lost((1, "a"), (2, "b")))
    store.record_rejections("r2", "wide", lost((1, "other")))
    for _ in range(2):
        store.record_rejections("r1", "wide", lost((2, "c"), (3, "d")))
    found = sorted((r.run_id, r.record_locator, r.reason) for r in store.meta("rejections").collect())
    assert found == [("r1", "line:1", "a"), ("r1", "line:2", "c"), ("r1", "line:3", "d"), ("r2", "line:1", "other")]


def test_result_and_many_entities(spark, store):
    rows = wide_rows(spark, *((f"e{k:04}", datetime(2024, 1, 1), float(k)) for k in range(400)))
    store.publish(rows, "wide", "1", "1")
    found = store.result("wide", entity=[f"e{k:04}" for k in range(300)], limit=5)
    assert found.units == {"power": "kW"} and found.limit == 5 and found.rows.count() == 5 and found.snapshot_id == store.live_snapshot("wide")
    assert found.rows.schema["power"].metadata == {"dataset_id": "wide", "snapshot_id": found.snapshot_id, "unit": "kW"}
    many = store.load("wide", entity=[f"e{k:04}" for k in range(300)] + ["absent"])
    assert many.count() == 300 and "e0123" not in many._jdf.queryExecution().optimizedPlan().toString().split("LocalRelation")[0]
    named = store.load("wide", entity=spark.createDataFrame([("e0001",), ("e0002",), ("e0001",)], "entity_id string"))
    assert named.count() == 2
    assert store.load("wide", entity=spark.createDataFrame([], "entity_id string")).count() == 0
    with pytest.raises(DeclarationError):
        store.load("wide", entity=spark.createDataFrame([(1,)], "entity_id long"))


def test_no_local_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from tideglass.session import shared_path

    spark = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(ValueError, match="checkpoint.dir"):
        shared_path(spark, "x")


def _plans(spark, call):
    """The executed plans of the writes that a call makes."""
    found = []
    save = DataFrameWriter.parquet

    def seen(self, path, *a, **k):
        found.append((path, self._df._jdf.queryExecution().executedPlan().toString()))
        return save(self, path, *a, **k)

    DataFrameWriter.parquet = seen
    try:
        call()
    finally:
        DataFrameWriter.parquet = save
    return found


def test_stored_rows_are_sorted_once_and_in_key_order(spark, tmp_path):
    """A partitioned write keeps the order of rows within each file; with another order it would sort them again."""
    store = Store(spark, str(tmp_path / "store"), Registry([recast.ORDERS]))
    days = spark.range(4000).select(F.lpad((F.col("id") * 7919 % 50).cast("string"), 7, "0").alias("entity_id"), F.expr("timestamp'1995-01-01' + make_dt_interval(cast(id * 31 % 1500 as int))").alias("time_start"), F.col("id").cast("double").alias("total"))
    days = days.dropDuplicates(["entity_id", "time_start"]).withColumn("time_end", F.expr("time_start + INTERVAL '1' DAY")).select("entity_id", "time_start", "time_end", "total")
    writes = _plans(spark, lambda: store._write(days, recast.ORDERS, "run_x", "src"))
    (path, plan), = [w for w in writes if "/data/" in w[0]]
    sort = next(line for line in plan.splitlines() if "Sort [" in line)
    assert sort.index("year") < sort.index("entity_bucket") < sort.index("entity_id") < sort.index("time_start")


def test_first_rejections_of_a_run_are_written_once(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), Registry([recast.ORDERS]))
    lost = lambda n, reason: spark.range(n).select(*tables.rejection(F.lit("s"), F.concat(F.lit("line:"), F.col("id").cast("string")), F.lit("x"), F.lit(reason), F.lit("raw"), F.lit(0), F.struct("id")))
    writes = _plans(spark, lambda: store.record_rejections("run_a", "orders_daily", lost(20, "first")))
    assert len(writes) == 1
    store.record_rejections("run_a", "orders_daily", lost(5, "again"))
    store.record_rejections("run_b", "orders_daily", lost(3, "other"))
    assert {(r.run_id, r.reason): r["count"] for r in store.meta("rejections").groupBy("run_id", "reason").count().collect()} == {("run_a", "first"): 15, ("run_a", "again"): 5, ("run_b", "other"): 3}
