"""Quantiles, nearest values, spans and neighbours against plain versions, with a hot group, and what their plans hold."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideglass.operators import analysis, ranges
from tideglass.plans import tables

T0 = datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().toString()


def hot_rows():
    random.seed(1)
    rows = [("hot", random.choice([random.gauss(0, 1), 1.5])) for _ in range(3000)] + [(random.choice("abc"), float(random.randrange(20))) for _ in range(300)]
    return rows + [("one", 7.0), ("none", None), (None, 1.0), (None, 2.0), ("wild", float("inf")), ("wild", 0.0)]


def test_quantiles(spark):
    rows, wanted = hot_rows(), [0.0, 0.1, 0.5, 0.99, 1.0]
    found = {(r.g, r.q): (r.measured, r.n) for r in ranges.quantiles(spark.createDataFrame(rows, "g string, x double"), "g", "x", wanted).collect()}
    groups = {g for g, x in rows if x is not None}
    assert {g for g, _ in found} == groups and len(found) == len(groups) * len(wanted)
    for g in groups - {"wild"}:
        own = [x for h, x in rows if h == g and x is not None]
        for q in wanted:
            assert found[g, q][1] == len(own) and found[g, q][0] == pytest.approx(np.quantile(own, q), abs=1e-12)
    assert found["wild", 0.0] == (0.0, 2) and found["wild", 1.0] == (float("inf"), 2)


def test_quantiles_by_group_and_plan(spark):
    df = spark.createDataFrame(hot_rows(), "g string, x double")
    made = ranges.quantiles(df, "g", "x", {"hot": [0.25], "a": [0.5, 0.75], "absent": [0.5]})
    assert sorted((r.g, r.q) for r in made.collect()) == [("a", 0.5), ("a", 0.75), ("hot", 0.25)]
    assert ranges.quantiles(df, "g", "x", {}).count() == 0 and ranges.quantiles(df.limit(0), "g", "x", [0.5]).count() == 0
    shown = plan(made)
    assert "percentile" not in shown and "collect_list(x" not in shown and "windowspecdefinition(g, x" not in shown
    assert "windowspecdefinition(g" in shown and "_range" in shown  # a group's values are ordered range by range


@pytest.mark.parametrize("values, aims", [([1, 2, 4, 8, 100], [-5, 1, 1.5, 3, 6, 54, 1000, None]), ([5], [1, 9]), ([], [1])])
def test_nearest(spark, values, aims):
    frame = lambda xs: spark.createDataFrame([(None if x is None else float(x),) for x in xs], "x double")
    found = {r.aim: r.near for r in ranges.nearest_values(frame([*values, *values, None]), frame([*aims, *aims])).collect()}
    assert found == ({float(a): min((abs(v - a), float(v)) for v in values)[1] for a in aims if a is not None} if values else {})


def test_nearest_of_many(spark):
    random.seed(2)
    values, aims = sorted(random.sample(range(100_000), 700)), random.sample(range(-50, 100_050), 900)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that many ranges hold no value
    try:
        made = ranges.nearest_values(spark.createDataFrame([(v,) for v in values[:3] + values[-400:]], "v int"), spark.createDataFrame([(a,) for a in aims], "a int"))
        found = {r.aim: r.near for r in made.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == {float(a): min((abs(v - a), float(v)) for v in values[:3] + values[-400:])[1] for a in aims}


def test_nearest_grid_without_cross_join(spark):
    grid = spark.createDataFrame([(float(x), float(y), x * 10 + y) for x in range(6) for y in range(4)], "lon double, lat double, v int")
    targets = spark.createDataFrame([("a", 1.5, 2.9), ("b", -9.0, 9.0), ("c", None, 1.0), ("d", 4.51, 0.2)], "id string, x double, y double")
    made = analysis.nearest_grid(grid, targets, [("lon", "x"), ("lat", "y")])
    assert {r.id: r.v for r in made.collect()} == {"a": 13, "b": 3, "d": 50}
    shown = plan(made)
    assert "Cartesian" not in shown and "NestedLoop" not in shown and "hint" not in shown.lower()


def test_nearest_grid_sums_a_coordinate_before_targets_meet_it(spark):
    grid = spark.createDataFrame([(x, v) for x in (0, 10) for v in range(50)], "x int, v int")
    targets = spark.createDataFrame([(f"t{k}", float(k % 20)) for k in range(40)] + [("none", None)], "id string, at double")
    made = analysis.nearest_grid(grid, targets, [("x", "at")], n=F.count("*"), least=F.min("v"))
    found = made.collect()
    assert sorted((r.id, r.x, r.n, r.least) for r in found) == sorted((f"t{k}", 0 if k % 20 <= 5 else 10, 50, 0) for k in range(40))
    assert "Aggregate [x" in made._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[1]  # the grid's side


def test_grid_sums_refuse_another_unit_anywhere(spark):
    at = F.lit("2024-01-01").cast("timestamp")
    grid = spark.createDataFrame([(0, "K", 3.0), (0, "K", 2.0), (90, "C", 1.0)], "x int, unit string, v double").withColumn("time", at)
    targets = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "entity_id string, at double")
    sums = {"n": F.count("*"), "least": F.min("v")}
    fine = tables.parse_grid(grid.filter("unit = 'K'"), targets, "v", "unit", "K", [("x", "at")], **sums)
    assert sorted((r.entity_id, r.n, r.least) for r in fine.collect()) == [("a", 2, 2.0), ("b", 2, 2.0)]
    with pytest.raises(Exception, match="unit is not as declared: C"):
        tables.parse_grid(grid, targets, "v", "unit", "K", [("x", "at")], **sums).collect()


def spans_of(rows):
    """Merged, overlapping and gaps of (entity, start, end) by one pass in order."""
    merged, crossed, open_ = [], [], []
    for e in {r[0] for r in rows}:
        own = sorted((s, t) for f, s, t in rows if f == e)
        reach, first = own[0][1], own[0][0]
        for k, (s, t) in enumerate(own):
            if k and s < reach:
                crossed.append((e, s, t, reach))
            if k and s > reach:
                merged.append((e, first, reach))
                open_.append((e, reach, s))
                first = s
            reach = max(reach, t)
        merged.append((e, first, reach))
    return merged, crossed, open_


def random_spans(n, hot):
    random.seed(n)
    rows = []
    for _ in range(n):
        s = T0 + timedelta(minutes=random.randrange(60 * 24 * 12))
        rows.append(("hot" if random.random() < hot else random.choice("abcd"), s, s + timedelta(minutes=random.choice([0, 5, 30, 600, 3000]))))
    return rows


@pytest.mark.parametrize("n, hot, every", [(400, 0.5, "day"), (60, 0.3, "hour"), (300, 0.9, "month")])
def test_spans(spark, n, hot, every):
    rows = random_spans(n, hot)
    df = spark.createDataFrame(rows + [(None, T0, T0 + timedelta(hours=1)), ("a", None, T0), ("a", T0, None)], "e string, s timestamp, t timestamp").repartition(5)
    merged, crossed, open_ = spans_of(rows)
    tuples = lambda made: sorted(tuple(r) for r in made.collect() if r[0] is not None)
    assert tuples(analysis.merged_spans(df, "e", "s", "t", every)) == sorted(merged)
    assert tuples(analysis.overlaps(df, "e", "s", "t", every)) == sorted(crossed)
    assert tuples(analysis.gaps(df, "e", "s", "t", every)) == sorted(open_)
    assert "windowspecdefinition(e, s" not in plan(analysis.merged_spans(df, "e", "s", "t", every))


def test_uncovered(spark):
    published, chosen = random_spans(300, 0.5), random_spans(200, 0.5)
    merged, _, _ = spans_of(chosen)
    frame = lambda rows: spark.createDataFrame([(e, s, t, "x") for e, s, t in rows], "e string, start timestamp, end timestamp, note string")
    lost = [r for r in published if not any(m[0] == r[0] and m[1] <= r[1] and r[2] <= m[2] for m in merged)]
    made = analysis.uncovered(frame(published), frame(chosen).drop("note"), "e")
    assert made.columns == ["e", "start", "end", "note"] and sorted(tuple(r)[:3] for r in made.collect()) == sorted(lost)
    assert analysis.uncovered(frame(published), frame(chosen).limit(0).drop("note"), "e").count() == len(published)


def test_neighbours(spark):
    random.seed(4)
    rows = [(random.choice(["hot", "hot", "a"]), T0 + timedelta(hours=7 * k), k) for k in range(120)]
    found = ranges.neighbours(spark.createDataFrame(rows, "e string, at timestamp, v int"), "e", "at", ["v"]).collect()
    for e in ("hot", "a"):
        own = [r for r in rows if r[0] == e]
        for k, r in enumerate(own):
            [x] = [f for f in found if f.v == r[2]]
            assert (x._before and x._before.v) == (own[k - 1][2] if k else None) and (x._after and x._after.v) == (own[k + 1][2] if k + 1 < len(own) else None)


def test_hot_entity_is_several_tasks(spark):
    df = spark.createDataFrame([("hot", T0 + timedelta(hours=k), T0 + timedelta(hours=k + 1)) for k in range(24 * 60)], "e string, s timestamp, t timestamp")
    kept = ranges.segments(df, "s").groupBy("e", "_range").agg(F.count("*").alias("n")).collect()
    assert len(kept) == 60 and max(r.n for r in kept) == 24
    assert [tuple(r) for r in analysis.merged_spans(df, "e", "s", "t").collect()] == [("hot", T0, T0 + timedelta(hours=24 * 60))]
