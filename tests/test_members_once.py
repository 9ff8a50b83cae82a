"""Files of a manifest are decoded once, and small ones share a batch of lines."""

import gzip

from pyspark.sql import functions as F

from tideglass import job_queries
from tideglass.plans import members


def test_members_are_decoded_once(spark, sf_dir):
    """Preambles and the rows behind them come from the lines as written."""
    plan = job_queries.member_values(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan


def test_lines_of_files_that_share_a_batch(spark):
    """Each line keeps its file and number, beside empty files and one of several batches."""
    large = [f"{k}," + "x" * 60 for k in range(100_000)]
    texts = {"a.csv": "1\r\n2", "b.csv": "", "c.csv.gz": "\n".join(large) + "\n", "d.csv": "3\n\n4\n"}
    files = spark.createDataFrame([(n, gzip.compress(t.encode()) if n.endswith(".gz") else t.encode()) for n, t in texts.items()], "file_name string, content binary").coalesce(1)
    lines = members.member_lines(files)
    assert sorted(tuple(r) for r in lines.filter("source <> 'c.csv.gz'").collect()) == [("a.csv", 1, "1"), ("a.csv", 2, "2"), ("d.csv", 1, "3"), ("d.csv", 2, ""), ("d.csv", 3, "4")]
    right = lines.filter("source = 'c.csv.gz'").agg(F.count("*"), F.count_if(F.substring_index("raw", ",", 1).cast("long") == F.col("line_number") - 1)).first()
    assert tuple(right) == (len(large), len(large))
