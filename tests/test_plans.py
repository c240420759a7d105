"""What the physical plans must look like to hold up on large data."""

import re

import pytest
from pyspark.sql import functions as F

from zonepipe.contract import Contract
from zonepipe.operators import scd2
from zonepipe.operators.synth import synth_actives
from zonepipe.operators.transform import transform
from zonepipe.plans.dataset import stage_dataset
from zonepipe.plans.lookup import lookup_batch, matched_versions, update_lookup
from zonepipe.plans.queries import QUERIES
from zonepipe.sources.lookup import LookupStore
from zonepipe.sources.zones import scan_zone, stage


@pytest.fixture(scope="module")
def zone(spark, tmp_path_factory):
    """A raw zone, and a lookup of two runs, on disk."""
    contract = Contract.known("actives", str(tmp_path_factory.mktemp("zone")))
    stage(synth_actives(spark.range(500), "id"), contract.transform.source)
    raw = scan_zone(spark, contract.transform.source)
    update_lookup(spark, raw.filter("state < 'N'"), contract, "2024-01-01", 1)
    update_lookup(spark, raw, contract, "2024-01-02", 2)
    return contract, raw, LookupStore.of(spark, contract)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan):
    return re.findall(r"Exchange (\w+)", plan)


def test_transform_is_one_pass(zone):
    contract, raw, _ = zone
    plan = plan_of(transform(raw, contract))
    assert exchanges(plan) == []
    assert plan.count("Project") == 1


def test_batch_reads_three_columns_and_limits_groups_before_the_exchange(zone):
    contract, raw, _ = zone
    plan = plan_of(lookup_batch(raw, contract))
    assert "ReadSchema: struct<advertising_id:string,timestamp:bigint,user_id:string>" in plan
    assert "PushedFilters: [IsNotNull(advertising_id)]" in plan
    assert exchanges(plan) == ["hashpartitioning"]
    above, below = plan.split("Exchange hashpartitioning")
    assert "sha2" in above and "sha2" not in below
    assert "WindowGroupLimit" in below


def test_step_shuffles_each_side_once(zone):
    contract, raw, store = zone
    step = scd2.scd2_step(store.active(), lookup_batch(raw, contract), contract.keys, contract.tracked, "2024-01-03")
    plan = plan_of(step)
    assert exchanges(plan) == ["hashpartitioning", "hashpartitioning"]
    assert plan.count("SortMergeJoin") == 1


def test_small_batch_leaves_the_open_versions_in_place(spark, zone, tmp_path):
    contract, raw, store = zone
    lookup_batch(raw, contract).write.parquet(f"{tmp_path}/batch")
    batch = spark.read.parquet(f"{tmp_path}/batch")
    plan = plan_of(scd2.scd2_matched(store.active_to_change(9), batch, contract.keys, contract.tracked))
    assert plan.count("BroadcastHashJoin") == 1 and "hashpartitioning" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(scd2.scd2_matched(store.active_to_change(9), batch, contract.keys, contract.tracked))
        assert exchanges(plan) == ["hashpartitioning", "hashpartitioning"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["scd2_merge_actives", "scd2_merge_viewership"])
def test_merge_evaluates_each_input_once(spark, name):
    plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert len(re.findall(r"FileScan parquet .*events.parquet", plan)) == 2


def test_hot_date_is_written_by_many_tasks(spark, tmp_path):
    contract = Contract.known("actives", str(tmp_path), partitions=("date",))
    rows = synth_actives(spark.range(60_000), "id").withColumn("date", F.lit("2024-01-01"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "300k")
    try:
        stage_dataset(rows, contract)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    folder = tmp_path / "staging" / "actives" / "date=2024-01-01"
    assert len(list(folder.glob("*.parquet"))) > 4


def test_dates_that_share_a_partition_are_not_split(spark, tmp_path):
    rows = spark.range(0, 100_000, 1, 4).withColumns({"text": F.sha2(F.col("id").cast("string"), 256), "date": F.col("id") % 100})
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        stage(rows, str(tmp_path / "zone"), ["date"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    # 8 shuffle partitions of some 900 KB, split over pieces of a map task each, wrote up to 4 files of a date.
    assert len(list((tmp_path / "zone").glob("date=*/part-*"))) == 100


def test_hot_key_is_reduced_before_the_exchange(spark):
    """A third of all rows on one key: each map task sends it once."""
    n = 30_000
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("string")
    rows = spark.range(0, n, 1, 6).select(key.alias("k"), F.col("id").alias("t"))
    latest = scd2.dedupe_batch(rows, ("k",), ("t",))
    assert latest.filter("k = '0'").first().t == n - 3
    kept = [r for r in latest.collect()]
    assert len(kept) == n - n // 3 + 1
    metrics = written_rows(latest)
    assert metrics <= n - n // 3 + 6


def written_rows(df):
    """Rows the first exchange of an executed plan wrote."""
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "Exchange" in text
    stage = plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") else plan
    while not stage.getClass().getSimpleName().startswith("ShuffleQueryStage"):
        stage = stage.children().head()
    return stage.plan().metrics().apply("shuffleRecordsWritten").value()


def test_staging_shuffles_raw_values(zone):
    contract, raw, _ = zone
    plan = plan_of(transform(raw, contract, spread_by="date"))
    above, below = plan.split("Exchange hashpartitioning")
    assert "sha2" in above and "sha2" not in below


def test_first_run_has_no_join(zone):
    contract, raw, store = zone
    step = scd2.scd2_step(store.active(before=1), lookup_batch(raw, contract), contract.keys, contract.tracked, "2024-01-03")
    plan = plan_of(step)
    assert "Join" not in plan
    assert exchanges(plan) == ["hashpartitioning"]


def test_window_rebuild_limits_groups_before_the_first_exchange(zone):
    contract, raw, _ = zone
    feed = raw.select("advertising_id", "user_id", "timestamp", "date")
    plan = plan_of(scd2.scd2_history(feed, contract.keys, contract.tracked, contract.recency, "date"))
    assert exchanges(plan) == ["hashpartitioning", "hashpartitioning"]
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning")[-1]


def above(plan, line):
    """Operators from one line of a plan up to its root."""
    lines = plan.splitlines()
    depth, found = lines[line].index(lines[line].lstrip(" :+-")), []
    for text in reversed(lines[:line]):
        at = text.index(text.lstrip(" :+-")) if text.strip() else depth
        if at < depth:
            found.append(text.lstrip(" :+-*0123456789()"))
            depth = at
    return found


def test_merge_leaves_a_snapshot_where_it_is(spark, tmp_path):
    contract = Contract.known("actives", str(tmp_path))
    stage(synth_actives(spark.range(400), "id"), contract.transform.source)
    raw = scan_zone(spark, contract.transform.source)
    store = LookupStore.of(spark, contract)
    update_lookup(spark, raw.filter("state < 'S'"), contract, "2024-01-01", 1)
    assert store.compact() == 1
    changed = raw.withColumn("user_id", F.concat("user_id", F.lit("x")))
    update_lookup(spark, changed.filter("state < 'G'"), contract, "2024-01-02", 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        matched = matched_versions(store, lookup_batch(raw, contract), contract, 3)
        plan = plan_of(matched)
        # Before the first join nothing happens to the snapshot but a sort inside each bucket.
        scans = [i for i, line in enumerate(plan.splitlines()) if "Bucketed: true" in line]
        assert len(scans) == 1
        path = above(plan, scans[0])
        join = next(i for i, p in enumerate(path) if "SortMergeJoin" in p)
        assert not any("Exchange" in p for p in path[:join])
        assert "SelectedBucketsCount: 8 out of 8" in plan
        # Closed versions are taken from what was found, not from the snapshot.
        assert "LeftAnti" not in path[join] and any("LeftAnti" in p for p in path[join + 1 :])
        rows = {tuple(r) for r in matched.select("advertising_id", "status").collect()}
        report = update_lookup(spark, raw, contract, "2024-01-03", 3)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert (report.changed, report.unchanged) == (sum(s == "changed" for _, s in rows), sum(s == "unchanged" for _, s in rows))
    assert report.changed and report.unchanged and len(rows) == report.changed + report.unchanged
    assert spark.catalog.listTables() == []


def test_snapshot_with_odd_names_and_two_keys(spark, tmp_path):
    contract = Contract.known("actives", str(tmp_path / "it's here"), pii=("advertising_id",), keys=("advertising_id", "city"), tracked=("state",))
    rows = synth_actives(spark.range(50), "id")
    store = LookupStore.of(spark, contract)
    update_lookup(spark, rows, contract, "2024-01-01", 1)
    before = sorted(map(repr, store.read().collect()))
    store.compact()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = rows.select("advertising_id", "city")
        plan = plan_of(store.active().join(ids, ["advertising_id", "city"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan and len(exchanges(plan)) == 1
    assert sorted(map(repr, store.read().collect())) == before
    assert update_lookup(spark, rows.withColumn("state", F.lit("?")), contract, "2024-01-02", 2).changed == len(before)
    assert sorted(r.update_date is None for r in store.read().collect()) == [False] * len(before) + [True] * len(before)
