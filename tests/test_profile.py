import pytest
from pyspark.sql import functions as F

from zonepipe.operators import profile as p


def numbers(spark, first, last):
    return spark.range(first, last).select(
        F.col("id").alias("n"),
        (F.col("id") % 1000).cast("string").alias("few"),
        F.when(F.col("id") % 2 == 0, F.col("id") / 4).alias("half"),
        F.array("id").alias("list"),
    )


def test_merged_profiles_equal_the_whole_within_the_error(spark, tmp_path):
    for at in range(4):
        p.store_profile(numbers(spark, at * 5000, at * 5000 + 5000), str(tmp_path), f"a{at}")
    stored = p.stored_profiles(spark, str(tmp_path))
    whole = numbers(spark, 0, 20000)
    for got in (p.merge(stored), p.profile(whole)):
        rows = {r["column"]: r for r in p.summary(got).collect()}
        assert (rows["n"]["n_rows"], rows["n"]["n_values"], rows["half"]["n_values"]) == (20000, 20000, 10000)
        assert (rows["n"]["least"], rows["n"]["most"]) == (0, 19999)
        assert rows["few"]["least"] is None and rows["few"]["quantiles"] is None
        assert rows["list"]["n_distinct"] is None and rows["list"]["n_values"] == 20000
        checks = p.held_against(p.summary(got), whole.drop("list")).collect()
        assert len(checks) == 3 and all(r["distinct_ok"] and r["ranks_ok"] in (True, None) for r in checks)


def test_a_wrong_profile_is_found_out(spark):
    summed = p.summary(p.profile(numbers(spark, 0, 5000)))
    rows = {r["column"]: r for r in p.held_against(summed, numbers(spark, 0, 20000).drop("list")).collect()}
    assert not rows["n"]["distinct_ok"] and not rows["n"]["ranks_ok"] and rows["few"]["distinct_ok"]


def test_an_arrival_again_replaces_its_profile(spark, tmp_path):
    p.store_profile(numbers(spark, 0, 10), str(tmp_path), "a")
    p.store_profile(numbers(spark, 0, 20), str(tmp_path), "b")
    p.store_profile(numbers(spark, 0, 30), str(tmp_path), "a")
    rows = p.merge(p.stored_profiles(spark, str(tmp_path))).where("column = 'n'").collect()
    assert [r["n_rows"] for r in rows] == [50]


@pytest.mark.parametrize("rows", [[], [(None, None)], [(float("nan"), "x")]])
def test_odd_tables(spark, rows):
    got = p.summary(p.merge(p.profile(spark.createDataFrame(rows, "`a.b` double, t string"))))
    by = {r["column"]: r for r in got.collect()}
    assert by["a.b"]["n_rows"] == len(rows) and by["a.b"]["quantiles"] is None and by["a.b"]["least"] is None
    assert by["t"]["n_distinct"] == sum(t is not None for _, t in rows)


def test_types_that_grow_wider_still_merge(spark, tmp_path):
    p.store_profile(spark.createDataFrame([(1,), (2,)], "n int"), str(tmp_path), "a")
    p.store_profile(spark.createDataFrame([(2,), (2**40,)], "n long"), str(tmp_path), "b")
    (row,) = p.summary(p.merge(p.stored_profiles(spark, str(tmp_path)))).collect()
    assert (row["n_values"], row["n_distinct"], row["most"]) == (4, 3, 2**40)
