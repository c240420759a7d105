"""Every corpus query on real, odd and empty tables."""

import re

import pytest

from tests.compare import duckdb_over, duckdb_rows, spark_rows
from zonepipe.llm.oracle import ORACLE
from zonepipe.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
NATIVE = ("op3_sharding", "op7_line_dedup", "op9_exact_dedup", "op13_quality_rules")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    names, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_names, expected = duckdb_rows(duckdb_over(SF_DIR), ORACLE[name])
    assert names == expected_names
    assert rows == expected
    assert rows


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - {"op11_lexical_search", "op12_prefix_trie"}))
def test_one_row_per_input_row(spark, odd_dir, name):
    rows = QUERIES[name](spark, odd_dir).collect()
    source = "pages" if name.startswith("op2_") else "documents"
    table = spark.read.parquet(f"{odd_dir}/{source}.parquet")
    assert sorted(str(r[0]) for r in rows) == sorted(str(r[0]) for r in table.collect())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_empty_results(spark, odd_dir, empty_dir, name):
    empty = QUERIES[name](spark, empty_dir)
    assert empty.collect() == []
    assert empty.dtypes == QUERIES[name](spark, odd_dir).dtypes


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", plan)


@pytest.mark.parametrize("name", ["op1_suffix_dedup", "op4_simhash", "op8_mixing", "op9_exact_dedup", "op11_lexical_search", "op13_quality_rules"])
def test_result_does_not_depend_on_partitions(spark, odd_dir, tmp_path, name):
    expected = spark_rows(QUERIES[name](spark, odd_dir))
    other = str(tmp_path)
    for table in ("documents", "benchmark", "labels"):
        rows = spark.read.parquet(f"{odd_dir}/{table}.parquet")
        rows.orderBy(rows.columns[1], rows.columns[0]).coalesce(1).write.parquet(f"{other}/{table}.parquet")
    assert spark_rows(QUERIES[name](spark, other)) == expected
