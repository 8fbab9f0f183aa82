"""Every registered query against its DuckDB SQL, and the comparison against itself."""

import pytest

import __spark_entry__ as entry
from checks.compare import differences, duck

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_oracle(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLE[name]) == []


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 5


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_comparison_sees_differences(spark, con):
    sql = "SELECT 1 AS a, 'x' AS b UNION ALL SELECT 2, 'y'"
    frame = lambda rows, ddl="a int, b string": spark.createDataFrame(rows, ddl)
    assert differences(frame([(2, "y"), (1, "x")]), con, sql) == []
    assert differences(frame([(2, "y"), (1, "z")]), con, sql)
    assert differences(frame([(1, "x")]), con, sql)
    assert differences(frame([(2, "y"), (1, "x")], "a bigint, b string"), con, sql)
    assert differences(frame([(2, "y"), (1, "x")], "c int, b string"), con, sql)
