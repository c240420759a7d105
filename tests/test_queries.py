"""Every registered query against its SQL statement on whole tables."""

import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))

import __spark_entry__ as registry  # noqa: E402

from zonepipe.plans.oracle import ORACLE  # noqa: E402
from zonepipe.plans.queries import QUERIES  # noqa: E402

from tests.compare import duckdb_over, duckdb_rows, spark_rows  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return duckdb_over(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    df = registry.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", plan)
    names, rows = spark_rows(df)
    expected_names, expected = duckdb_rows(db, registry.oracle_sql()[name])
    assert names == expected_names
    assert rows == expected
    assert rows


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(registry.queries())


def test_entry(spark):
    assert registry.entry(spark).count() > 0
