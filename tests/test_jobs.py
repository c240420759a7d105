import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tests.test_contract import contract_file
from zonepipe.__main__ import arguments
from zonepipe.contract import Contract
from zonepipe.operators.quality import QualityError
from zonepipe.operators.synth import synth_actives, synth_viewership
from zonepipe.plans.dataset import check_staging, run_dataset, scan_arrivals
from zonepipe.sources.lookup import LookupStore, lookup_schema
from zonepipe.sources.session import CHECKPOINT_DIR, work_folder
from zonepipe.sources.zones import land, stage

MAKERS = {"actives": synth_actives, "viewership": synth_viewership}


@pytest.mark.parametrize("name", ["actives", "viewership"])
def test_whole_run_twice(spark, tmp_path, name):
    path = tmp_path / "contracts.json"
    path.write_text(json.dumps(contract_file(str(tmp_path))))
    contract = Contract.load(spark, str(path), name)
    rows = MAKERS[name](spark.range(12), "id")
    arrival = land(rows, contract, "20240101_000000")
    reports = [run_dataset(spark, contract, "2024-01-01", 1, arrival) for _ in range(2)]
    assert reports[0] == reports[1]
    assert all(c["passed"] for c in reports[0].checks)
    assert reports[0].lookup.new == 12

    land(rows, contract, "20240102_000000")
    again = run_dataset(spark, contract, "2024-01-02", 2)
    assert (again.lookup.new, again.lookup.unchanged, again.lookup.updated) == (0, 12, False)
    assert scan_arrivals(spark, contract).count() == 24
    store = LookupStore.of(spark, contract)
    assert store.versions() == [1, 2]
    assert store.read().count() == 12


def files_of(folder):
    return {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_a_run_touches_its_own_arrival_only(spark, tmp_path):
    contract = Contract.known("actives", str(tmp_path))
    rows = synth_actives(spark.range(40), "id").withColumns({"date": F.lit("2024-01-05"), "month": F.lit("01")})
    arrivals = [land(rows.filter(F.col("timestamp") % 2 == i), contract, str(i)) for i in range(2)]
    run_dataset(spark, contract, "2024-01-01", 1, arrivals[0])
    staging = tmp_path / "staging"
    before = files_of(staging)
    run_dataset(spark, contract, "2024-01-02", 2, arrivals[1])
    after = files_of(staging)
    assert before.items() <= after.items() and len(after) > len(before)
    assert scan_arrivals(spark, contract).count() == 40
    assert LookupStore.of(spark, contract).read().count() == 40
    run_dataset(spark, contract, "2024-01-02", 2, arrivals[1])
    assert scan_arrivals(spark, contract).count() == 40
    # The whole zone again: the same rows.
    run_dataset(spark, contract, "2024-01-03", 3)
    assert scan_arrivals(spark, contract).count() == 40


def test_an_empty_arrival_among_others_stops_the_run(spark, tmp_path):
    contract = Contract.known("actives", str(tmp_path))
    land(synth_actives(spark.range(5), "id"), contract, "1")
    land(synth_actives(spark.range(0), "id"), contract, "2")
    with pytest.raises(QualityError, match="availability.actives_2"):
        run_dataset(spark, contract, "2024-01-01", 1)


def test_a_partition_value_that_is_no_date_is_a_verdict(spark, tmp_path):
    contract = Contract.known("actives", str(tmp_path))
    rows = synth_actives(spark.range(5), "id").withColumn("date", F.when(F.col("timestamp") > 0, "no date"))
    arrival = land(rows, contract, "1")
    report = run_dataset(spark, contract, "2024-01-01", 1, arrival)
    failed = {c["check"] for c in report.checks if not c["passed"]}
    assert failed == {"cast_loss"}
    staging = contract.transform.destination
    stage(scan_arrivals(spark, contract).drop("date"), f"{staging}/month=01/date=soon/arrival=actives_9")
    counted = [Row(check=c, subject="actives", actual="5") for c in ("availability", "rows")]
    with pytest.raises(QualityError, match="partition_value.date.: expected 0, got 5"):
        check_staging(spark, "advertising_id", contract, ["actives_9"], counted)


def test_row_counts_hold_rows_without_a_first_value(spark, tmp_path):
    contract = Contract.known("viewership", str(tmp_path))
    rows = synth_viewership(spark.range(12), "id")
    rows = rows.withColumn("advertising_id", F.when(F.col("duration") % 2 == 0, F.col("advertising_id")))
    report = run_dataset(spark, contract, "2024-01-01", 1, land(rows, contract, "1"))
    assert [c["actual"] for c in report.checks if c["check"] == "row_count"] == ["12"]


def test_raw_identifiers_never_reach_staging(spark, tmp_path):
    contract = Contract.known("actives", str(tmp_path))
    rows = synth_actives(spark.range(15), "id")
    land(rows, contract, "1")
    run_dataset(spark, contract, "2024-01-01", 1)
    staged = scan_arrivals(spark, contract)
    for column in contract.pii:
        raw = {r[0] for r in rows.select(column).collect()}
        assert not raw & {r[0] for r in staged.select(column).collect()}


def test_empty_dataset_stops_the_run(spark, tmp_path):
    contract = Contract.known("actives", str(tmp_path))
    land(synth_actives(spark.range(0), "id"), contract, "1")
    with pytest.raises(QualityError, match="availability"):
        run_dataset(spark, contract, "2024-01-01", 1)
    assert LookupStore.of(spark, contract).versions() == []


def test_missing_column_stops_the_run(spark, tmp_path):
    contract = Contract.known("actives", str(tmp_path))
    land(synth_actives(spark.range(3), "id").drop("user_latitude"), contract, "1")
    with pytest.raises(QualityError, match="user_latitude"):
        run_dataset(spark, contract, "2024-01-01", 1)


@pytest.mark.parametrize("name", ["actives", "viewership"])
def test_synthetic_rows_do_not_depend_on_partitioning(spark, name):
    make = MAKERS[name]
    one = make(spark.range(0, 200, 1, 1), "id", seed=3)
    many = make(spark.range(0, 200, 1, 9).repartition(4), "id", seed=3)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, many.collect()))
    other = make(spark.range(0, 200, 1, 1), "id", seed=4)
    assert sorted(map(repr, one.collect())) != sorted(map(repr, other.collect()))
    assert one.select("advertising_id").distinct().count() == 200
    assert all(r.month == r.date[5:7] for r in one.collect())
    assert len(one.columns) == {"actives": 12, "viewership": 20}[name]


def test_work_folder_is_in_the_shared_folder(spark):
    shared = spark.conf.get(CHECKPOINT_DIR)
    first, second = work_folder(spark), work_folder(spark)
    assert first.startswith(shared) and first != second


def test_command_line():
    args = arguments(["run", "actives", "--config", "c.json", "--as-of", "2024-01-01", "--version", "3"])
    assert (args.job, args.dataset, args.version, args.strict) == ("run", "actives", 3, False)
    with pytest.raises(SystemExit):
        arguments(["run", "actives", "--config", "c.json"])


def test_work_folder_without_the_setting(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "local[2]"

    first = work_folder(Session())
    assert first != work_folder(Session()) and "zonepipe-" in first
    monkeypatch.setattr(Session.sparkContext, "master", "yarn")
    with pytest.raises(ValueError, match=CHECKPOINT_DIR):
        work_folder(Session())
