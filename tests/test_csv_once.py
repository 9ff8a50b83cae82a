"""Lines of CSV are parsed once each, however many cells are named."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tideglass import job_queries
from tideglass.sources import lines as sources


def _parses(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_csv(")


@pytest.mark.parametrize("kind", ["commented", "headed", "pages"])
def test_a_line_is_parsed_once(spark, kind):
    if kind == "pages":
        rows = sources.api_pages(spark.createDataFrame([("s", 'a,b\r\n1,"x,y"\r\n2,z\r\n')], "source string, body string"), ["a", "b"])
        assert [(r.a, r.b) for r in rows.orderBy("row_number").collect()] == [("1", "x,y"), ("2", "z")]
    else:
        text = "# Station: 7\nid,name\n1,\"x,y\",z\n\n,,\n" if kind == "commented" else "Note\n\nid,name,c\n1,\"x,y\",z\n"
        lines = sources.lines_of(spark.createDataFrame([("s", text)], "source string, text string"), "source", "text")
        made = sources.commented_csv(lines, ["id", "name"], ["Station"], 4) if kind == "commented" else sources.headed_csv(lines, "name", 3)
        assert [r.cells for r in made.collect()] == [["1", "x,y", "z"]]
        rows = made.select(*(F.get("cells", F.lit(k)).alias(f"x{k}") for k in range(3))).filter("x0 = '1'")
    # a header is looked for in a pass of its own
    assert _parses(rows) <= (2 if kind == "headed" else 1)


def test_pages_and_their_counts_are_made_once(spark, sf_dir):
    """Neither side deals the events again when it is used."""
    for side in job_queries._pages(spark, sf_dir):
        plan = side._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Aggregate" not in plan
