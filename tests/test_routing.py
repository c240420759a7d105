import pytest
from pyspark.sql import functions as F

from zonepipe.contract import Contract
from zonepipe.operators.quality import QualityError
from zonepipe.sources.files import glob
from zonepipe.sources.lookup import LookupStore
from zonepipe.sources.zones import scan_zone, stage
from zonepipe.streaming import routing
from zonepipe.streaming.ingest import scan_streamed
from zonepipe.streaming.routing import Pending, Route, stream_route

ACTIVE = (
    "advertising_id string, location_source string, timestamp bigint, user_id string, "
    "user_latitude double, user_longitude double, month string, date string"
)
VIEW = (
    "advertising_id string, channel_name string, location_source array<string>, duration bigint, "
    "record_timestamp bigint, user_lat double, user_long double, month string, date string"
)


def active(spark, *ids, day="2024-01-01"):
    return spark.createDataFrame([(i, "s", 1, "u", 1.0, 2.0, day[5:7], day) for i in ids], ACTIVE).coalesce(1)


def view(spark, *ids, day="2024-01-01"):
    return spark.createDataFrame([(i, "c", ["s"], 1, 1, 1.0, 2.0, day[5:7], day) for i in ids], VIEW).coalesce(1)


@pytest.fixture
def world(spark, tmp_path):
    class World:
        landing = str(tmp_path / "landing")
        actives, viewership = (Contract.known(n, str(tmp_path)) for n in ("actives", "viewership"))
        day = F.to_date("date")
        reports = []

        def land(self, rows, name):
            stage(rows, f"{self.landing}/{name}")

        def run(self, schemas=True, **more):
            shapes = active(spark).schema, view(spark).schema
            routes = [
                Route(c, s if schemas else None, self.day) for c, s in zip((self.actives, self.viewership), shapes)
            ]
            before = len(self.reports)
            started = stream_route(
                spark, self.landing, routes, str(tmp_path / "checkpoint"), report=self.reports.append, **more
            )
            started.awaitTermination()
            return self.reports[before:]

        def staged(self, contract, shape):
            return sorted(str(r[0]) for r in scan_streamed(spark, contract, shape(spark).schema).select("date").collect())

        def keys(self, contract):
            return sorted((r[0], str(r["begin_date"])) for r in LookupStore.of(spark, contract).read().collect())

        pending = Pending(spark, str(tmp_path / "checkpoint-pending"))

    World.reports = []
    return World()


def test_rows_go_to_the_dataset_of_their_arrival(spark, world):
    world.land(active(spark, "A", "B"), "actives_1")
    world.land(view(spark, "V"), "viewership_1")
    world.land(spark.range(3), "orders_1")
    world.land(active(spark, "X"), "activesomething_1")
    (report,) = world.run()
    assert {n: [b.rows for b in done] for n, done in report.done.items()} == {"actives": [2], "viewership": [1]}
    assert report.unrouted >= 2 and not report.errors
    assert [k for k, _ in world.keys(world.actives)] == ["A", "B"] and [k for k, _ in world.keys(world.viewership)] == ["V"]
    assert world.run() == []


def test_a_dataset_that_fails_does_not_stop_the_others(spark, world):
    world.land(active(spark, "A"), "actives_1")
    world.land(view(spark, None), "viewership_1")
    (report,) = world.run()
    assert isinstance(report.errors["viewership"], QualityError) and list(report.done) == ["actives"]
    assert [k for k, _ in world.keys(world.actives)] == ["A"] and world.keys(world.viewership) == []
    assert world.pending.batches("viewership") == [0] and world.pending.batches("actives") == []

    # Later arrivals of the dataset wait behind it; the other goes on.
    world.land(active(spark, "B", day="2024-01-02"), "actives_2")
    world.land(view(spark, "W", day="2024-01-02"), "viewership_2")
    again, report = world.run()
    assert again.batch_id is None and list(again.errors) == ["viewership"] and not again.done
    assert list(report.done) == ["actives"] and list(report.errors) == ["viewership"]
    assert world.pending.batches("viewership") == [0, 1] and world.keys(world.viewership) == []

    # Mended under its own name: what was put aside is gone, the rest is taken.
    world.land(view(spark, "V"), "viewership_1")
    again, report = world.run()
    assert not again.errors and not report.errors and world.pending.batches("viewership") == []
    assert [k for k, _ in world.keys(world.viewership)] == ["V", "W"]
    assert world.staged(world.viewership, view) == ["2024-01-01", "2024-01-02"]
    assert world.run() == []


def test_a_crash_after_any_step_is_made_good(spark, world, monkeypatch):
    world.land(active(spark, "A"), "actives_1")
    world.land(view(spark, "V"), "viewership_1")

    # Died after actives was done: the micro-batch is delivered again.
    real, take = routing._process, routing._take

    def killed(spark, way, *rest):
        if way.contract.dataset == "viewership" and len(rest) > 2:
            raise RuntimeError("killed")
        take(spark, way, *rest)

    with monkeypatch.context() as patch, pytest.raises(Exception, match="killed"):
        patch.setattr(routing, "_take", killed)
        world.run()
    assert [k for k, _ in world.keys(world.actives)] == ["A"] and world.keys(world.viewership) == []
    (report,) = world.run()
    assert not report.errors and [k for k, _ in world.keys(world.actives)] == ["A"]
    assert len(world.staged(world.actives, active)) == len(world.staged(world.viewership, view)) == 1

    # Failed once staged, and died once the second try was done but still on the list.
    world.land(view(spark, "W", "X", day="2024-01-02"), "viewership_2")

    def late(*args):
        real(*args)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(routing, "_process", late)
        (report,) = world.run()
        assert str(report.errors["viewership"]) == "lost" and world.pending.batches("viewership") == [1]
    assert world.run() == [] and world.pending.batches("viewership") == []
    assert len(world.staged(world.viewership, view)) == 3
    assert [k for k, _ in world.keys(world.viewership)] == ["V", "W", "X"]


def test_leftovers_of_a_failed_try_are_removed(spark, world, monkeypatch):
    world.land(view(spark, "W", "X"), "viewership_1")
    with monkeypatch.context() as patch:
        patch.setattr("zonepipe.streaming.ingest.update_lookup", lambda *a, **k: 1 / 0)
        (report,) = world.run()
    assert isinstance(report.errors["viewership"], ZeroDivisionError)
    assert len(world.staged(world.viewership, view)) == 2
    world.land(view(spark, "W", day="2024-01-03"), "viewership_1")
    world.run()
    assert world.staged(world.viewership, view) == ["2024-01-03"]
    assert scan_zone(spark, world.viewership.ingest.destination).count() == 1


def test_shapes_and_days_are_found_where_they_are_not_given(spark, world):
    world.day = None
    world.land(view(spark, "V"), "viewership_[1]")
    world.land(view(spark, "W").withColumn("location_source", F.lit("text")), "viewership_2")
    (report,) = world.run(schemas=False)
    assert not report.errors and [b.rows for b in report.done["viewership"]] == [2]
    assert len({day for _, day in world.keys(world.viewership)}) == 1
    assert glob(spark, f"{world.viewership.ingest.destination}/*")


def test_no_content_is_read_to_deal_files(spark, world):
    world.land(active(spark, "A"), "actives_1")
    files = spark.read.format("binaryFile").schema(routing.FILE).option("recursiveFileLookup", "true").load(world.landing)
    plan = files.select("path")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
