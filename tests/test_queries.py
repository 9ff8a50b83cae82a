"""Every registered query of the engine against its SQL on the smallest tables."""

from datetime import datetime

import duckdb
import pytest

from tideglass import queries as registered

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(df):
    cells = lambda r: [None if x is None or x != x else round(float(x), 6) if isinstance(x, float) else str(x) for x in r]
    return sorted((cells(r) for r in df[sorted(df.columns)].astype(object).values.tolist()), key=str)


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    found = registered.queries()[name](spark, sf_dir).toPandas()
    sql = registered.oracle_sql().get(name)
    if sql is None:
        assert len(found)
        return
    wanted = duck.sql(sql).df()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows(found) == rows(wanted)


def test_manifest_windows_of_customers_with_one_order(spark, tmp_path):
    at = "o_orderkey long, o_custkey long, o_orderdate timestamp"
    orders = [(k, k, datetime(1997, 3, 1)) for k in range(18)] + [(100 + k, k, datetime(1998, 3, 1)) for k in range(18, 27)] + [(200 + k, k, datetime(1998, 4, 1)) for k in range(18, 27)]
    spark.createDataFrame(orders, at).write.parquet(f"{tmp_path}/orders.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    found = registered.queries()["manifest_windows"](spark, str(tmp_path)).toPandas()
    assert rows(found) == rows(con.sql(registered.oracle_sql()["manifest_windows"]).df())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns[0] == "entity_id"
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
