"""Slots of a month's record: what the checks and the cutting make of odd ones, and how many rows of code name them."""

from __future__ import annotations

import datetime

import pytest

from tideglass import recast
from tideglass.plans.fixed_width import MONTHLY, DayEra, Element, parse_daily

ELEMENTS = (Element("001", "rain", 0.1, start_minute=0, missing=("T",)),)
ERAS = (DayEra("1990-01-01", None, 6),)


def _record(month, cells):
    return "0000007" + month + "001" + "".join(f"{v:>6}{f}" for v, f in cells)


def _parsed(spark, raw):
    lines = spark.createDataFrame([("s", 1, raw)], "source string, line_number long, raw string")
    return parse_daily(lines, ELEMENTS, ERAS).accepted.orderBy("time_start").collect()


def test_slots_keep_values_flags_and_markers(spark):
    cells = [("1", "2"), ("-99999", "M"), ("T", " "), ("123456", "é"), ("1e1", "\n")] + [("0", " ")] * 26
    rows = _parsed(spark, _record("199002", cells))
    assert len(rows) == 28  # days 29 to 31 drop out
    assert [r.value for r in rows[:5]] == [pytest.approx(0.1), None, None, pytest.approx(12345.6), pytest.approx(1.0)]
    assert [r.quality_flag for r in rows[:5]] == ["2", "M", "", "é", "\n"]
    assert rows[27].time_start == datetime.datetime(1990, 2, 28, 6)


@pytest.mark.parametrize("bad", ["", "1 2", "x", "1\x1f2", "NaN", "1d"])
def test_a_slot_that_is_no_number_ends_the_job(spark, bad):
    with pytest.raises(Exception, match="line 1: slot"):
        _parsed(spark, _record("199001", [("1", " ")] * 30 + [(bad, "5")]))


@pytest.mark.parametrize("job", [recast.monthly_archive, recast.order_months])
def test_months_do_not_aggregate_each_slot_by_itself(spark, tmp_path, job):
    rows = [(1, 1, "P", datetime.datetime(1995, 2, 3)), (2, 1, "F", datetime.datetime(1995, 2, 3)), (3, 1, "F", datetime.datetime(1995, 2, 28))]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    made = job(spark, str(tmp_path))
    assert made._jdf.queryExecution().optimizedPlan().toString().count("max(") + made._jdf.queryExecution().optimizedPlan().toString().count("count(") < 10
    if job is recast.monthly_archive:
        assert made.first().raw == _record("199502", [("2", "P") if d == 3 else ("1", " ") if d == 28 else ("0", " ") for d in range(1, 32)]).replace("0000007", "0000001")
    else:
        r = made.first()
        assert [(r[f"value{d}"], r[f"flag{d}"]) for d in (1, 3, 28)] == [(0.0, None), (2.0, "P"), (1.0, None)]
