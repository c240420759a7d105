import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from zonepipe.contract import Contract
from zonepipe.operators.quality import QualityError
from zonepipe.plans.lookup import update_lookup
from zonepipe.operators.transform import transform
from zonepipe.sources.lookup import LookupStore, lookup_schema
from zonepipe.sources.zones import land, scan_zone, stage
from zonepipe.streaming import compaction
from zonepipe.streaming.compaction import compact_staging, current, drop_compacted
from zonepipe.streaming.ingest import _DAY, Once, compact_streamed, process_batch, scan_streamed, stream_ingest

RAW = (
    "advertising_id string, location_source string, timestamp bigint, user_id string, "
    "user_latitude double, user_longitude double, month string, date string"
)
ARRIVALS = [
    [("A", "u1", 1, "2024-01-01"), ("B", "u1", 1, "2024-01-01")],
    [("A", "u2", 2, "2024-01-02"), ("A", "u3", 3, "2024-01-02"), ("C", "u1", 1, "2024-01-02")],
    [("A", "u3", 4, "2024-01-03"), ("B", None, 2, "2024-01-03"), (None, "u9", 1, "2024-01-03")],
]


def frame(spark, arrival):
    rows = [(k, "s", t, u, 1.0, 2.0, d[5:7], d) for k, u, t, d in arrival]
    return spark.createDataFrame(rows, RAW).coalesce(1)


def snapshot(spark, contract):
    store = LookupStore.of(spark, contract)
    return sorted(map(repr, store.read().collect()))


def staged(spark, contract, schema):
    return sorted(map(repr, scan_streamed(spark, contract, schema).collect()))


def start(spark, contract, tmp_path, schema, **more):
    query = stream_ingest(
        spark,
        contract,
        str(tmp_path / "checkpoint"),
        schema,
        options={"maxFilesPerTrigger": "1"},
        **more,
    )
    query.awaitTermination()
    return query


@pytest.fixture
def contract(tmp_path):
    return Contract.known("actives", str(tmp_path / "stream"))


def test_stream_equals_batch_and_restart_adds_nothing(spark, contract, tmp_path):
    schema = frame(spark, ARRIVALS[0]).schema
    for number, arrival in enumerate(ARRIVALS[:2]):
        land(frame(spark, arrival), contract, str(number))
    start(spark, contract, tmp_path, schema, arrival_day=F.to_date("date"))
    land(frame(spark, ARRIVALS[2]), contract, "2")
    start(spark, contract, tmp_path, schema, arrival_day=F.to_date("date"))

    batch = Contract.known("actives", str(tmp_path / "batch"))
    for version, arrival in enumerate(ARRIVALS, start=1):
        update_lookup(spark, frame(spark, arrival), batch, arrival[0][3], version)
    assert snapshot(spark, contract) == snapshot(spark, batch)

    everything = frame(spark, sum(ARRIVALS, []))
    columns = scan_streamed(spark, contract, schema).columns
    expected = sorted(map(repr, transform(everything, contract).select(columns).collect()))
    assert staged(spark, contract, schema) == expected
    assert scan_zone(spark, contract.ingest.destination).count() == everything.count()

    before = snapshot(spark, contract)
    query = start(spark, contract, tmp_path, schema, arrival_day=F.to_date("date"))
    assert not any(p["numInputRows"] for p in query.recentProgress)
    assert snapshot(spark, contract) == before
    assert staged(spark, contract, schema) == expected


def test_redelivered_batch_changes_nothing(spark, contract):
    schema = frame(spark, ARRIVALS[0]).schema
    for batch_id, arrival in enumerate(ARRIVALS):
        dated = frame(spark, arrival).withColumn(_DAY, F.to_date("date"))
        process_batch(dated, batch_id, contract)
    before = snapshot(spark, contract), staged(spark, contract, schema)
    process_batch(dated, batch_id, contract)
    assert (snapshot(spark, contract), staged(spark, contract, schema)) == before


def test_empty_batch_is_skipped(spark, contract):
    dated = frame(spark, ARRIVALS[0]).withColumn(_DAY, F.to_date("date"))
    process_batch(dated.filter("false"), 0, contract)
    assert snapshot(spark, contract) == []


def test_default_day_is_the_day_of_arrival(spark, contract, tmp_path):
    land(frame(spark, ARRIVALS[0]), contract, "0")
    start(spark, contract, tmp_path, None)
    store = LookupStore.of(spark, contract)
    days = {r.begin_date for r in store.read().collect()}
    today = dt.datetime.now(dt.timezone.utc).date()
    assert days <= {today, today - dt.timedelta(days=1)} and len(days) == 1


def test_rows_are_routed_and_checked(spark, contract, tmp_path):
    schema = frame(spark, ARRIVALS[0]).schema
    land(frame(spark, ARRIVALS[2]), contract, "0")
    stage(frame(spark, ARRIVALS[0]), f"{contract.ingest.source}/orders_1")
    reports = []
    start(spark, contract, tmp_path, schema, arrival_day=F.to_date("date"), report=reports.append)
    assert sum(r.rows for r in reports) == 3 and sum(r.unrouted for r in reports) == 2
    keys = [c for r in reports for c in r.checks if c["check"] == "null_key"]
    assert [(c["actual"], c["passed"]) for c in keys] == [("1", False)]
    store = LookupStore.of(spark, contract)
    assert {r.user_id for r in store.read().collect()} == {"u3", None}


def test_a_failed_gate_stops_the_micro_batch(spark, contract):
    rows = [(None, "s", 1, "u", 1.0, 2.0, "01", "2024-01-01")]
    dated = spark.createDataFrame(rows, RAW).withColumn(_DAY, F.to_date("date"))
    with pytest.raises(QualityError, match="availability"):
        process_batch(dated, 0, contract)
    assert LookupStore.of(spark, contract).versions() == []


def test_a_late_micro_batch_begins_no_version_before_an_earlier_run(spark, contract):
    for batch_id in (0, 1):
        dated = frame(spark, ARRIVALS[1 - batch_id]).withColumn(_DAY, F.to_date("date"))
        process_batch(dated, batch_id, contract)
    assert {str(r.begin_date) for r in LookupStore.of(spark, contract).read().collect()} == {"2024-01-02"}


def test_compaction_leaves_the_rows_in_fewer_files(spark, contract, tmp_path):
    schema = frame(spark, ARRIVALS[0]).schema
    for batch_id in range(3):
        process_batch(frame(spark, ARRIVALS[0]).withColumn(_DAY, F.to_date("date")), batch_id, contract)
    compact_streamed(spark, contract, schema, str(tmp_path / "compact"))
    assert len(list((tmp_path / "compact").rglob("*.parquet"))) == 1
    assert spark.read.parquet(str(tmp_path / "compact")).count() == 6


def test_rows_delivered_again_are_staged_once(spark, contract, tmp_path):
    schema = frame(spark, ARRIVALS[0]).schema
    land(frame(spark, ARRIVALS[1]), contract, "1")
    start(spark, contract, tmp_path, schema, arrival_day=F.to_date("date"), once=Once())
    # The same rows under another name, with older ones, and those of another dataset.
    land(frame(spark, ARRIVALS[1] + ARRIVALS[0]), contract, "copy")
    stage(frame(spark, ARRIVALS[2]), f"{contract.ingest.source}/orders_1")
    failed = []

    def fail(report):
        if not failed:
            failed.append(report)
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        start(spark, contract, tmp_path, schema, arrival_day=F.to_date("date"), once=Once(), report=fail)
    start(spark, contract, tmp_path, schema, arrival_day=F.to_date("date"), once=Once())
    land(frame(spark, ARRIVALS[2] + ARRIVALS[0]), contract, "2")
    start(spark, contract, tmp_path, schema, arrival_day=F.to_date("date"), once=Once())
    everything = frame(spark, sum(ARRIVALS, []))
    columns = scan_streamed(spark, contract, schema).columns
    assert staged(spark, contract, schema) == sorted(map(repr, transform(everything, contract).select(columns).collect()))
    assert failed


def test_rows_are_known_by_the_columns_named(spark, contract, tmp_path):
    schema = frame(spark, ARRIVALS[0]).schema
    land(frame(spark, [("A", "u1", 1, "2024-01-01"), ("B", "u1", 1, "2024-01-01")]), contract, "0")
    start(spark, contract, tmp_path, schema, once=Once(("advertising_id", "timestamp")))
    land(frame(spark, [("A", "other", 1, "2024-01-02"), ("A", "u1", 2, "2024-01-02")]), contract, "1")
    start(spark, contract, tmp_path, schema, once=Once(("advertising_id", "timestamp")))
    assert sorted(r["timestamp"] for r in scan_streamed(spark, contract, schema).collect()) == [1, 1, 2]


def live_folders(contract):
    return [p for p in Path(contract.transform.destination).rglob("ingest_batch=*") if "_compacted" not in p.parts]


def test_compaction_in_place(spark, contract, tmp_path, monkeypatch):
    schema, zone = frame(spark, ARRIVALS[0]).schema, contract.transform.destination
    assert compact_staging(spark, contract, schema) is None and drop_compacted(spark, contract) == []
    for number, arrival in enumerate(ARRIVALS[:2]):
        land(frame(spark, arrival), contract, str(number))
    start(spark, contract, tmp_path, schema)
    before = staged(spark, contract, schema)

    def killed(*_):
        raise InterruptedError

    with monkeypatch.context() as patch, pytest.raises(InterruptedError):
        patch.setattr(compaction, "touch", killed)
        compact_staging(spark, contract, schema)
    assert current(spark, zone) == [] and staged(spark, contract, schema) == before

    assert (one := compact_staging(spark, contract, schema)) and (one.first, one.last) == (0, 1)
    assert staged(spark, contract, schema) == before and len(live_folders(contract)) == 2
    assert len(drop_compacted(spark, contract)) == 2 and live_folders(contract) == []
    assert staged(spark, contract, schema) == before
    assert compact_staging(spark, contract, schema) is None

    # A batch that is delivered again adds nothing; a later one counts at once.
    process_batch(frame(spark, ARRIVALS[1]).withColumn(_DAY, F.lit(dt.date(2024, 1, 2))), 1, contract)
    assert staged(spark, contract, schema) == before
    land(frame(spark, ARRIVALS[2]), contract, "2")
    start(spark, contract, tmp_path, schema)
    after = staged(spark, contract, schema)
    assert len(after) == 8 and set(before) < set(after)

    # The second range holds the new batch alone; a whole one replaces both.
    assert (two := compact_staging(spark, contract, schema)) and (two.first, two.last) == (2, 2)
    assert len(list(Path(two.path).rglob("*.parquet"))) == 1
    assert [(r.first, r.last) for r in current(spark, zone)] == [(0, 1), (2, 2)]
    assert staged(spark, contract, schema) == after
    compact_staging(spark, contract, schema, whole=True)
    assert compact_staging(spark, contract, schema, whole=True) is None
    assert [(r.first, r.last) for r in current(spark, zone)] == [(0, 2)]
    dropped = drop_compacted(spark, contract)
    assert {p.rsplit("/", 2)[1] + "/" + p.rsplit("/", 1)[1] for p in dropped if "_compacted" in p} == {"from=0/upto=1", "from=2/upto=2"}
    assert live_folders(contract) == [] and staged(spark, contract, schema) == after


def test_a_compaction_that_lost_rows_is_not_published(spark, contract, tmp_path, monkeypatch):
    schema = frame(spark, ARRIVALS[0]).schema
    land(frame(spark, ARRIVALS[0]), contract, "0")
    start(spark, contract, tmp_path, schema)
    monkeypatch.setattr(compaction, "stage", lambda rows, *a, **k: stage(rows.limit(1), *a, **k))
    with pytest.raises(QualityError, match="expected 2"):
        compact_staging(spark, contract, schema)
    assert len(staged(spark, contract, schema)) == 2
