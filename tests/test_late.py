"""Runs out of the order of their dates, against runs in order and against a plain model."""

import itertools
import os
import random

import pytest

from tests.test_lookup_store import RAW, contract, stored  # noqa: F401
from zonepipe.plans.lookup import RunCounts, update_in_any_order, update_lookup
from zonepipe.sources.lookup import LookupStore, StaleRun

DAYS = [f"2024-01-{d:02d}" for d in range(1, 10)]


def merge(spark, contract, version, day, pairs):  # noqa: F811
    raw = spark.createDataFrame([(k, u, 1, "x") for k, u in pairs], RAW)
    return update_in_any_order(spark, raw, contract, day, version)


def plain(batches):
    """``(version, day, {key: user})`` in any order -> versions of a type 2 table."""
    by_day = {}
    for _, day, rows in sorted(batches, key=lambda b: (b[1], b[0])):
        by_day.setdefault(day, {}).update(rows)
    found = []
    for key in {k for rows in by_day.values() for k in rows}:
        steps = []
        for day in sorted(by_day):
            if key in by_day[day] and (not steps or steps[-1][1] != by_day[day][key]):
                steps.append((day, by_day[day][key]))
        for i, (day, user) in enumerate(steps):
            end = steps[i + 1][0] if i + 1 < len(steps) else None
            found.append((key, user, day, end, end is None))
    return sorted(found, key=repr)


def texts(rows):
    return sorted([(k, u, str(b), e and str(e), a) for k, u, b, e, a in rows], key=repr)


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[1::2])
def test_three_batches_in_any_order(spark, contract, order):  # noqa: F811
    days = [("A", "u1"), ("B", "u1")], [("A", "u2"), ("B", "u1"), ("C", "u3")], [("A", "u1"), ("B", "u2"), (None, "u")]
    batches = []
    for version, number in enumerate(order, start=1):
        merge(spark, contract, version, DAYS[number], days[number])
        batches.append((version, DAYS[number], {k: u for k, u in days[number] if k}))
        assert texts(stored(spark, contract)) == plain(batches)
    assert LookupStore.of(spark, contract).versions() == [1, 2, 3]


@pytest.mark.parametrize("seed", [2])
def test_random_batches_with_snapshots_and_repeats(spark, contract, seed):  # noqa: F811
    rng = random.Random(seed)
    batches, store = [], LookupStore.of(spark, contract)
    for version in range(1, 7):
        day = rng.choice(DAYS)
        rows = {k: rng.choice("uv") for k in "ABCDE" if rng.random() < 0.6}
        if rng.random() < 0.3:
            merge(spark, contract, version, rng.choice(DAYS), [(k, "wrong") for k in "ABX"])
        counts = merge(spark, contract, version, day, list(rows.items()))
        known = {k for _, _, r in batches for k in r}
        assert counts.new == len(rows.keys() - known) and counts.new + counts.changed + counts.unchanged == len(rows)
        batches.append((version, day, rows))
        assert texts(stored(spark, contract)) == plain(batches), (version, day)
        if rng.random() < 0.4:
            store.compact()
            assert texts(stored(spark, contract)) == plain(batches)
        open_rows = [tuple(map(str, r)) for r in store.active().select("advertising_id", "begin_date").collect()]
        assert len(open_rows) == len({k for k, _ in open_rows}) == len(known | rows.keys())


def test_a_late_batch_that_tells_nothing_new_writes_no_version(spark, contract):  # noqa: F811
    merge(spark, contract, 1, DAYS[0], [("A", "u"), ("B", "u")])
    merge(spark, contract, 2, DAYS[5], [("A", "u"), ("B", "v")])
    before = stored(spark, contract)
    assert merge(spark, contract, 3, DAYS[3], [("A", "u")]) == RunCounts(3, DAYS[3], 0, 0, 1)
    changes = {c for v, c in LookupStore.of(spark, contract).listing().changes if v == 3}
    assert changes == {"seen"} and stored(spark, contract) == before


def test_only_keys_of_the_batch_are_rewritten(spark, contract):  # noqa: F811
    merge(spark, contract, 1, DAYS[0], [(f"k{i}", "u") for i in range(50)])
    merge(spark, contract, 2, DAYS[5], [(f"k{i}", "v") for i in range(50)])
    merge(spark, contract, 3, DAYS[3], [("k7", "w")])
    listing = LookupStore.of(spark, contract).listing()
    rows = {c: spark.read.parquet(p).count() for (v, c), p in listing.changes.items() if v == 3}
    assert rows == {"seen": 1, "spliced": 2, "dropped_closed": 1}
    kept = [r for r in texts(stored(spark, contract)) if r[0] == "k7"]
    assert kept == [("k7", "u", DAYS[0], DAYS[3], False), ("k7", "v", DAYS[5], None, True), ("k7", "w", DAYS[3], DAYS[5], False)]


def test_a_lookup_without_kept_batches_takes_no_late_one(spark, contract):  # noqa: F811
    raw = spark.createDataFrame([("A", "u", 1, "x")], RAW)
    update_lookup(spark, raw, contract, DAYS[4], 1)
    with pytest.raises(StaleRun, match="kept no batch"):
        merge(spark, contract, 2, DAYS[2], [("A", "v")])
    with pytest.raises(StaleRun):
        update_lookup(spark, raw, contract, DAYS[2], 2)


def test_an_uncommitted_late_run_does_not_count(spark, contract):  # noqa: F811
    merge(spark, contract, 1, DAYS[4], [("A", "u")])
    merge(spark, contract, 2, DAYS[2], [("A", "v")])
    os.unlink(f"{contract.lookup}/v=2/as_of={DAYS[2]}/_SUCCESS")
    assert texts(stored(spark, contract)) == [("A", "u", DAYS[4], None, True)]
    merge(spark, contract, 2, DAYS[1], [("A", "w")])
    assert texts(stored(spark, contract)) == plain([(1, DAYS[4], {"A": "u"}), (2, DAYS[1], {"A": "w"})])
