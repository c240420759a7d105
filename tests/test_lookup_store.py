import datetime as dt
import hashlib
import glob
import os

import pytest

from zonepipe.contract import Contract
from zonepipe.plans.lookup import RunCounts, lookup_batch, update_lookup
from zonepipe.operators.transform import transform
from zonepipe.sources import lookup as lookup_module
from zonepipe.sources.lookup import LookupStore, StaleRun, WrongFeed, lookup_schema

RAW = "advertising_id string, user_id string, timestamp bigint, city string"
D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture
def contract(tmp_path):
    return Contract.known("actives", str(tmp_path))


def run(spark, contract, version, day, *pairs):
    raw = spark.createDataFrame([(k, u, 1, "x") for k, u in pairs], RAW)
    return update_lookup(spark, raw, contract, day, version)


def stored(spark, contract):
    store = LookupStore.of(spark, contract)
    names = ("advertising_id", "user_id", "begin_date", "update_date", "flag_active")
    return sorted((tuple(r) for r in store.read().select(*names).collect()), key=repr)


def test_first_load_then_changes(spark, contract):
    assert run(spark, contract, 1, D1, ("A", "u1"), ("B", "u1")) == RunCounts(1, str(D1), 2, 0, 0)
    assert run(spark, contract, 2, D2, ("A", "u2"), ("C", "u1")) == RunCounts(2, str(D2), 1, 1, 0)
    last = run(spark, contract, 3, D3, ("A", "u2"), (None, "u7"))
    assert last == RunCounts(3, str(D3), 0, 0, 1) and not last.updated
    expected = [
        ("A", "u1", D1, D2, False),
        ("A", "u2", D2, None, True),
        ("B", "u1", D1, None, True),
        ("C", "u1", D2, None, True),
    ]
    assert stored(spark, contract) == expected


def test_pairs_hold_raw_and_masked_values(spark, contract):
    run(spark, contract, 1, D1, ("A", "u1"))
    store = LookupStore.of(spark, contract)
    row = store.read().first().asDict()
    assert row["advertising_id"] == "A" and row["Masked_advertising_id"] == sha("A")
    assert row["user_id"] == "u1" and row["Masked_user_id"] == sha("u1")
    types = [(f.name, f.dataType) for f in store.read().schema]
    assert types == [(f.name, f.dataType) for f in lookup_schema(contract)]


def test_replay_of_a_run_changes_nothing(spark, contract):
    run(spark, contract, 1, D1, ("A", "u1"))
    first = run(spark, contract, 2, D2, ("A", "u2"), ("B", "u1"))
    before = stored(spark, contract)
    assert run(spark, contract, 2, D2, ("A", "u2"), ("B", "u1")) == first
    assert stored(spark, contract) == before


def test_older_run_is_refused(spark, contract):
    run(spark, contract, 2, D2, ("A", "u1"))
    with pytest.raises(StaleRun):
        run(spark, contract, 1, D1, ("A", "u0"))


def test_uncommitted_run_does_not_count(spark, contract):
    run(spark, contract, 1, D1, ("A", "u1"))
    run(spark, contract, 2, D2, ("A", "u2"))
    os.unlink(f"{contract.lookup}/v=2/as_of={D2}/_SUCCESS")
    assert stored(spark, contract) == [("A", "u1", D1, None, True)]
    assert run(spark, contract, 3, D3, ("A", "u3")).changed == 1
    assert stored(spark, contract) == [("A", "u1", D1, D3, False), ("A", "u3", D3, None, True)]


def test_snapshots_take_the_place_of_older_changes(spark, contract):
    store = LookupStore.of(spark, contract)
    assert store.compact() is None and store.drop_superseded() == []
    for version, (day, user) in enumerate([(D1, "u1"), (D2, "u2")], start=1):
        run(spark, contract, version, day, ("A", user), ("B", "u"))
    before = stored(spark, contract)
    assert store.compact() == 2 and store.compact() == 2
    assert stored(spark, contract) == before
    assert store.drop_superseded() == []  # run 2 may have to be repeated
    run(spark, contract, 3, D3, ("A", "u3"), ("C", "u"))
    after = stored(spark, contract)
    assert len(store.drop_superseded()) == 2
    assert stored(spark, contract) == after and store.versions() == [1, 2, 3]
    assert run(spark, contract, 3, D3, ("A", "u3"), ("C", "u")).changed == 1
    assert stored(spark, contract) == after


def test_snapshot_of_a_replaced_run_goes_first(spark, contract):
    run(spark, contract, 1, D1, ("A", "u1"))
    run(spark, contract, 2, D2, ("A", "wrong"))
    LookupStore.of(spark, contract).compact()
    run(spark, contract, 2, D2, ("A", "u2"))
    assert stored(spark, contract) == [("A", "u1", D1, D2, False), ("A", "u2", D2, None, True)]


def test_run_without_a_change_is_committed_without_data(spark, contract):
    run(spark, contract, 1, D1, ("A", "u1"), ("B", "u1"))
    assert run(spark, contract, 2, D2, ("A", "u1"), ("B", "u1")) == RunCounts(2, str(D2), 0, 0, 2)
    assert LookupStore.of(spark, contract).versions() == [1, 2]
    assert not glob.glob(f"{contract.lookup}/v=2/*/change=*")
    assert stored(spark, contract) == [("A", "u1", D1, None, True), ("B", "u1", D1, None, True)]


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_repeat_with_corrected_input_replaces_the_run(spark, contract, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        right = [(f"k{i}", "u") for i in range(200)]
        run(spark, contract, 1, D1, *right)
        run(spark, contract, 2, D2, *[(k, "wrong") if i < 5 else (k, "u") for i, (k, _) in enumerate(right)])
        assert run(spark, contract, 2, D2, *right) == RunCounts(2, str(D2), 0, 0, 200)
        assert run(spark, contract, 3, D3, *right) == RunCounts(3, str(D3), 0, 0, 200)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert stored(spark, contract) == sorted([(k, u, D1, None, True) for k, u in right], key=repr)


def test_repeat_under_another_date_replaces_the_run(spark, contract):
    run(spark, contract, 1, D1, ("A", "u1"))
    run(spark, contract, 2, D3, ("A", "u2"))
    run(spark, contract, 2, D2, ("A", "u2"))
    assert stored(spark, contract) == [("A", "u1", D1, D2, False), ("A", "u2", D2, None, True)]


def test_two_runs_of_one_day(spark, contract):
    for version, user in enumerate(["u1", "u2", "u3"], start=1):
        run(spark, contract, version, D1, ("A", user))
    assert [r[1] for r in stored(spark, contract) if r[4]] == ["u3"]
    assert len(stored(spark, contract)) == 3


def test_dates_do_not_go_back(spark, contract):
    run(spark, contract, 1, D2, ("A", "u1"))
    with pytest.raises(StaleRun, match="lies before"):
        run(spark, contract, 2, D1, ("A", "u2"))


def test_batch_and_stream_do_not_mix(spark, contract):
    run(spark, contract, 1, D1, ("A", "u1"))
    raw = spark.createDataFrame([("A", "u2", 1, "x")], RAW)
    with pytest.raises(WrongFeed, match="fed by batch"):
        update_lookup(spark, raw, contract, D2, 2, feed="stream")


def test_a_read_lists_once(spark, contract, monkeypatch):
    run(spark, contract, 1, D1, ("A", "u1"))
    run(spark, contract, 2, D2, ("A", "u2"))
    calls, real = [], lookup_module.glob

    def counting(session, pattern):
        calls.append(pattern)
        return real(session, pattern)

    monkeypatch.setattr(lookup_module, "glob", counting)
    assert len(stored(spark, contract)) == 2
    assert len(calls) == 1


def test_composite_key_with_a_plain_column_and_an_uncast_tracked_one(spark, tmp_path):
    contract = Contract.known(
        "actives", str(tmp_path), pii=("advertising_id",), keys=("advertising_id", "city"), tracked=("points",)
    )
    schema = "advertising_id string, city string, points bigint, timestamp bigint"
    for version, (day, points) in enumerate([(D1, 1), (D2, 2)], start=1):
        raw = spark.createDataFrame([("A", "x", points, 1), ("A", "y", 1, 1), ("A", None, 9, 9)], schema)
        update_lookup(spark, raw, contract, day, version)
    names = ("city", "points", "begin_date", "update_date")
    rows = sorted((tuple(r) for r in LookupStore.of(spark, contract).read().select(*names).collect()), key=repr)
    assert rows == [("x", "1", D1, D2), ("x", "2", D2, None), ("y", "1", D1, None)]


def test_lookup_and_staging_mask_the_same_text(spark, tmp_path):
    contract = Contract.known(
        "actives", str(tmp_path), pii=("birthday",), keys=("birthday",), tracked=(), masks=("birthday",),
        casts={"birthday": "DateType()"}, partitions=(),
    )
    raw = spark.createDataFrame([("2024-1-5", 1)], "birthday string, timestamp bigint")
    assert lookup_batch(raw, contract).first().Masked_birthday == transform(raw, contract).first().birthday


def test_empty_store(spark, contract):
    assert stored(spark, contract) == []
    assert LookupStore.of(spark, contract).versions() == []


def test_batch_is_reduced_and_null_keys_left_out(spark, contract):
    raw = spark.createDataFrame(
        [("A", "u1", 1, "x"), ("A", "u2", 2, "x"), (None, "u3", 3, "x"), ("B", None, 1, "x")], RAW
    )
    batch = lookup_batch(raw, contract)
    assert sorted(tuple(r) for r in batch.collect()) == [
        ("A", sha("A"), "u2", sha("u2")),
        ("B", sha("B"), None, None),
    ]


def test_tracked_column_outside_the_identifiers(spark, tmp_path):
    contract = Contract.known("viewership", str(tmp_path), tracked=("channel_name",))
    for version, (day, channel) in enumerate([(D1, "one"), (D2, "two")], start=1):
        raw = spark.createDataFrame(
            [("A", channel, 1)], "advertising_id string, channel_name string, record_timestamp bigint"
        )
        update_lookup(spark, raw, contract, day, version)
    store = LookupStore.of(spark, contract)
    assert store.read().columns == [
        "advertising_id", "Masked_advertising_id", "channel_name", "begin_date", "update_date", "flag_active",
    ]
    rows = sorted(tuple(r)[2:] for r in store.read().collect())
    assert rows == [("one", D1, D2, False), ("two", D2, None, True)]


def test_pepper_changes_masks_only(spark, contract):
    raw = spark.createDataFrame([("A", "u1", 1, "x")], RAW)
    batch = lookup_batch(raw, contract, pepper="p").first()
    assert batch.advertising_id == "A" and batch.Masked_advertising_id == sha("pA")
