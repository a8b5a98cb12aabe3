"""Every registered query that has a SQL twin agrees with it."""

import os

import duckdb
import pytest

from docsift.plans import queries  # noqa: F401
from docsift.plans import registry
from tests.conftest import SF


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return con


def same(spark, duck, function, sql, tmp):
    function(spark, SF).write.mode("overwrite").parquet(tmp)
    duck.execute(f"CREATE OR REPLACE TABLE o AS {sql}")
    duck.execute(f"CREATE OR REPLACE TABLE s AS SELECT * FROM '{tmp}/*.parquet'")
    names = sorted(r[0] for r in duck.execute("DESCRIBE o").fetchall())
    assert names == sorted(r[0] for r in duck.execute("DESCRIBE s").fetchall())
    cols = ", ".join(f'"{n}"' for n in names)
    for a, b in (("o", "s"), ("s", "o")):
        assert duck.execute(f"SELECT {cols} FROM {a} EXCEPT ALL SELECT {cols} FROM {b}").fetchall() == []


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_agrees_with_sql(spark, duck, tmp_path, name):
    same(spark, duck, registry.queries()[name], registry.oracle_sql()[name], str(tmp_path / name))


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert len(__spark_entry__.entry(spark).columns) == 26
