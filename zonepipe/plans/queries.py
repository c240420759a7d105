"""Every operator as a query over the star-schema tables.

Each query takes ``(spark, sf_dir)``, runs over whole tables, and returns a
DataFrame.  ``zonepipe.plans.oracle`` states the same results in plain SQL.

To exercise the merge operators, the event feed is cut in two by region: rows up
to a region's date are what the lookup already knows, later rows are the batch.
The dates are set so that new, changed, unchanged and absent keys all occur.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepipe.contract import Contract
from zonepipe.functions import flatten_to_string
from zonepipe.operators import pii, profile, quality, scd2, synth
from zonepipe.operators.transform import cast_columns, mask_columns, staged_schema, transform
from zonepipe.plans.dataset import manifest_of, run_dataset, scan_arrivals, stage_dataset, with_arrivals
from zonepipe.plans.lookup import RunCounts, lookup_batch, update_in_any_order, update_lookup
from zonepipe.sources import star_schema
from zonepipe.sources.lookup import LookupStore
from zonepipe.sources.session import work_folder
from zonepipe.sources.verbatim import ingest_bytes
from zonepipe.sources.zones import ingest_raw, land, route_files, scan_staging, scan_zone, stage
from zonepipe.streaming.compaction import compact_staging, drop_compacted
from zonepipe.streaming.ingest import Once, scan_streamed, stream_ingest
from zonepipe.streaming.routing import Route, stream_route

Query = Callable[[SparkSession, str], DataFrame]

# Parameters shared with the SQL statements.
AS_OF = "2024-01-31"
STAMP = "20240131_000000"
KNOWN_UNTIL = {
    "AFRICA": "2023-12-31",
    "AMERICA": "2024-01-11",
    "ASIA": "2024-01-25",
    "EUROPE": "2024-01-28",
    "MIDDLE EAST": "2024-12-31",
}
KNOWN_UNTIL_ELSEWHERE = "2024-01-15"
RUN_DAYS = ("2024-01-10", "2024-01-20", AS_OF)
NARROW_DECIMAL = "DecimalType(4,2)"
SEED = 7

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def actives_contract(root: str = "", **changes) -> Contract:
    return Contract.known("actives", root, recency=("timestamp", "event_id"), **changes)


def viewership_contract(root: str = "", **changes) -> Contract:
    return Contract.known("viewership", root, recency=("record_timestamp", "event_id"), **changes)


def readable(df: DataFrame) -> DataFrame:
    """Array columns as text, so that results of any engine compare."""
    return df.withColumn(
        "location_source", flatten_to_string(F.col("location_source"), df.schema["location_source"].dataType)
    )


# --- scans and sinks ---------------------------------------------------------


@query("scan_zone")
def _scan_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = work_folder(spark)
    stage(star_schema.actives(spark, sf_dir), f"{zone}/actives_{STAMP}")
    return readable(scan_zone(spark, zone))


@query("ingest_raw")
def _ingest_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = viewership_contract(work_folder(spark))
    arrival = land(star_schema.viewership(spark, sf_dir), contract, STAMP)
    ingest_raw(spark, contract, arrival)
    return readable(scan_zone(spark, contract.ingest.destination))


@query("ingest_bytes")
def _ingest_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals copied byte by byte, their digests compared; returns the raw zone."""
    contract = viewership_contract(work_folder(spark))
    rows = star_schema.viewership(spark, sf_dir)
    for number, part in enumerate((F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1)):
        land(rows.filter(part), contract, f"{STAMP}_{number}")
    ingest_bytes(spark, contract)
    return readable(scan_zone(spark, contract.ingest.destination))


@query("scan_shapes")
def _scan_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An arrival for every date, in three shapes by turns, which do not merge; returns the zone."""
    contract = actives_contract(work_folder(spark), rename={"user_lattitude": "user_latitude"})
    rows = star_schema.actives(spark, sf_dir)
    shapes = (
        rows,
        readable(rows).withColumnRenamed("user_latitude", "user_lattitude"),
        rows.withColumn("timestamp", F.col("timestamp").cast("int")).drop("state"),
    )
    for number, shape in enumerate(shapes):
        # One job writes a shape's arrivals, each a folder of its own.
        own = shape.filter(F.day(F.to_date("date")) % len(shapes) == number)
        named = own.withColumn("arrived", F.concat(F.lit("actives_"), "date"))
        stage(named, f"{contract.ingest.source}/{number}", ["arrived"])
    return readable(scan_zone(spark, [f"{contract.ingest.source}/{n}" for n in range(len(shapes))], step=contract.transform))


@query("ingest_mixed")
def _ingest_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals of different shape: an old column name and text against a list; returns the raw zone."""
    contract = actives_contract(work_folder(spark), rename={"user_lattitude": "user_latitude"})
    rows = star_schema.actives(spark, sf_dir)
    early = F.col("date") <= RUN_DAYS[0]
    land(rows.filter(~early), contract, f"{STAMP}_1")
    older = readable(rows.filter(early)).withColumnRenamed("user_latitude", "user_lattitude")
    land(older.withColumn("only_here", F.col("event_id") % 10), contract, f"{STAMP}_0")
    ingest_raw(spark, contract)
    raw = scan_zone(spark, contract.ingest.destination, step=contract.transform)
    return readable(raw)


@query("route_files")
def _route_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = work_folder(spark)
    stage(star_schema.actives(spark, sf_dir), f"{landing}/actives_{STAMP}")
    stage(star_schema.viewership(spark, sf_dir), f"{landing}/viewership_{STAMP}")
    stage(star_schema.table(spark, sf_dir, "orders"), f"{landing}/orders_{STAMP}")
    return route_files(spark, landing, ("actives", "viewership"))


@query("stage_partitioned")
def _stage_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract, raw = _staged_actives(spark, sf_dir)
    return scan_staging(spark, contract.transform, staged_schema(raw.schema, contract))


@query("stage_flat")
def _stage_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = viewership_contract(work_folder(spark), partitions=())
    raw = star_schema.viewership(spark, sf_dir)
    stage_dataset(raw, contract)
    return scan_staging(spark, contract.transform, staged_schema(raw.schema, contract))


@query("synth_actives")
def _synth_actives(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = star_schema.table(spark, sf_dir, "events").select("event_id")
    return synth.synth_actives(ids, "event_id", SEED)


@query("synth_viewership")
def _synth_viewership(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = star_schema.table(spark, sf_dir, "events").select("event_id")
    return synth.synth_viewership(ids, "event_id", SEED)


# --- projections -------------------------------------------------------------


@query("cast_decimal")
def _cast_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    casts = {"user_latitude": "DecimalType()", "user_longitude": NARROW_DECIMAL}
    rows = star_schema.actives(spark, sf_dir).select("event_id", *casts)
    return cast_columns(rows, casts)


@query("flatten_array")
def _flatten_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star_schema.actives(spark, sf_dir).select("event_id", "location_source")
    return cast_columns(rows, {"location_source": "ArrayType-StringType"})


@query("cast_int")
def _cast_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    casts = {"duration": "IntegerType()", "record_timestamp": "IntegerType()"}
    rows = star_schema.viewership(spark, sf_dir).select("event_id", *casts)
    return cast_columns(rows, casts)


@query("cast_date")
def _cast_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star_schema.actives(spark, sf_dir).select("event_id", "date")
    return cast_columns(rows, {"date": "DateType()"})


@query("mask_columns")
def _mask_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star_schema.actives(spark, sf_dir).select("event_id", "advertising_id", "user_id", "timestamp")
    return mask_columns(rows, ["advertising_id", "user_id", "timestamp"])


@query("transform_actives")
def _transform_actives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform(star_schema.actives(spark, sf_dir), actives_contract())


@query("transform_viewership")
def _transform_viewership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform(star_schema.viewership(spark, sf_dir), viewership_contract())


@query("audit_columns")
def _audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star_schema.actives(spark, sf_dir).select("event_id", "advertising_id", "user_id")
    return pii.audit_columns(rows, AS_OF)


@query("pii_pairs")
def _pii_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star_schema.actives(spark, sf_dir)
    pairs = pii.pii_pairs(rows, [*actives_contract().pii, "not_in_frame"], ["event_id"])
    return pii.audit_columns(pairs, AS_OF)


@query("swap_masked")
def _swap_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = actives_contract().pii
    pairs = pii.pii_pairs(star_schema.actives(spark, sf_dir), ids, ["event_id", "city"])
    return pii.swap_masked(pairs, ids)


# --- type 2 lookup -----------------------------------------------------------


@query("dedupe_batch")
def _dedupe_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star_schema.actives(spark, sf_dir).select("advertising_id", "user_id", "timestamp", "event_id")
    return scd2.dedupe_batch(rows, ("advertising_id",), ("timestamp", "event_id"))


@query("scd2_initial")
def _scd2_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = lookup_batch(star_schema.actives(spark, sf_dir), actives_contract())
    return scd2.scd2_initial(batch, AS_OF)


@query("scd2_classify")
def _scd2_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.scd2_classify(*_active_and_batch(spark, sf_dir))


@query("scd2_new_keys")
def _scd2_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    active, batch, keys, _ = _active_and_batch(spark, sf_dir)
    return scd2.scd2_new_keys(active, batch, keys)


@query("scd2_change_rows")
def _scd2_change_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.scd2_change_rows(*_active_and_batch(spark, sf_dir))


@query("scd2_changes")
def _scd2_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.scd2_changes(*_active_and_batch(spark, sf_dir))


@query("scd2_change_summary")
def _scd2_change_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.scd2_change_summary(*_active_and_batch(spark, sf_dir))


@query("scd2_closed")
def _scd2_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.scd2_closed(scd2.scd2_step(*_active_and_batch(spark, sf_dir), AS_OF))


@query("scd2_inserted")
def _scd2_inserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.scd2_inserted(*_active_and_batch(spark, sf_dir), AS_OF)


@query("scd2_merge_actives")
def _scd2_merge_actives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge(star_schema.actives(spark, sf_dir), actives_contract())


@query("scd2_merge_viewership")
def _scd2_merge_viewership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge(star_schema.viewership(spark, sf_dir), viewership_contract())


@query("scd2_merge_channel")
def _scd2_merge_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = viewership_contract(tracked=("channel_name",))
    return _merge(star_schema.viewership(spark, sf_dir), contract)


@query("scd2_merge_composite")
def _scd2_merge_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three stored runs with a key of an identifier and a plain column, tracking an uncast number."""
    contract = actives_contract(
        work_folder(spark), pii=("advertising_id",), keys=("advertising_id", "city"), tracked=("points",)
    )
    rows = star_schema.actives(spark, sf_dir).withColumn("points", F.col("event_id") % 3)
    for version, day in enumerate(RUN_DAYS, start=1):
        update_lookup(spark, rows.filter(run_day() == day), contract, day, version)
    return LookupStore.of(spark, contract).read()


@query("scd2_history")
def _scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(star_schema.actives(spark, sf_dir), actives_contract())


@query("scd2_history_channel")
def _scd2_history_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = viewership_contract(tracked=("channel_name",))
    return _history(star_schema.viewership(spark, sf_dir), contract)


@query("lookup_update")
def _lookup_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, runs = _stored_lookup(spark, sf_dir)
    rows = [(r.version, r.as_of, r.new, r.changed, r.unchanged) for r in runs]
    schema = "version bigint, as_of string, n_new bigint, n_changed bigint, n_unchanged bigint"
    return spark.createDataFrame(rows, schema)


@query("lookup_scan")
def _lookup_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = _stored_lookup(spark, sf_dir)
    return store.read()


@query("lookup_replay")
def _lookup_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run with wrong rows is repeated with the right ones, then the next follows; the lookup."""
    contract = actives_contract(work_folder(spark))
    rows = star_schema.actives(spark, sf_dir)
    wrong = rows.withColumn("user_id", F.concat("user_id", F.lit("-wrong")))
    first, second, last = RUN_DAYS
    update_lookup(spark, rows.filter(run_day() == first), contract, first, 1)
    update_lookup(spark, wrong.filter(run_day() == second), contract, second, 2)
    LookupStore.of(spark, contract).compact()
    update_lookup(spark, rows.filter(run_day() == second), contract, second, 2)
    update_lookup(spark, rows.filter(run_day() == last), contract, last, 3)
    return LookupStore.of(spark, contract).read()


@query("lookup_compact")
def _lookup_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots between runs, what they replace removed; the lookup."""
    contract = actives_contract(work_folder(spark))
    rows = star_schema.actives(spark, sf_dir)
    store = LookupStore.of(spark, contract)
    for version, day in enumerate(RUN_DAYS, start=1):
        update_lookup(spark, rows.filter(run_day() == day), contract, day, version)
        store.drop_superseded()
        store.compact()
    return store.read()


@query("lookup_late")
def _lookup_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs in another order than their dates: the last, the first, the second; the lookup."""
    store = LookupStore.of(spark, _late_contract(spark, sf_dir, (2, 0, 1)))
    return store.read()


@query("lookup_late_daily")
def _lookup_late_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four dates' rows out of order, a snapshot between, the last run repeated; the lookup."""
    contract = viewership_contract(work_folder(spark), tracked=("channel_name",))
    rows, week = star_schema.viewership(spark, sf_dir), week_day()
    weeks = ("2024-01-07", "2024-01-14", "2024-01-21", AS_OF)
    for version, number in enumerate((1, 3, 0, 2, 2), start=1):
        if version == 3:
            LookupStore.of(spark, contract).compact()
        day = weeks[number]
        update_in_any_order(spark, rows.filter(week == day), contract, day, min(version, 4))
    return LookupStore.of(spark, contract).read()


@query("lookup_active")
def _lookup_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = _stored_lookup(spark, sf_dir)
    return scd2.lookup_active(store.active())


# --- checks ------------------------------------------------------------------


@query("validate_counts")
def _validate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validate_counts(star_schema.actives(spark, sf_dir))


@query("count_by_partition")
def _count_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract, raw = _staged_actives(spark, sf_dir)
    staged = scan_staging(spark, contract.transform, staged_schema(raw.schema, contract))
    return quality.count_by_partition(staged, contract.transform.partitions)


@query("validate_availability")
def _validate_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validate_availability(star_schema.viewership(spark, sf_dir), "viewership")


@query("validate_reconcile")
def _validate_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract, raw = _staged_actives(spark, sf_dir)
    staged = scan_staging(spark, contract.transform, staged_schema(raw.schema, contract))
    return quality.validate_reconcile(raw, staged, "actives")


@query("validate_types")
def _validate_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract, _ = _staged_actives(spark, sf_dir)
    return quality.validate_types(scan_staging(spark, contract.transform), contract)


@query("validate_cast_loss")
def _validate_cast_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    casts = {**actives_contract().transform.casts, "user_longitude": NARROW_DECIMAL}
    return quality.validate_cast_loss(star_schema.actives(spark, sf_dir), actives_contract(casts=casts))


@query("validate_raw")
def _validate_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validate_raw(star_schema.viewership(spark, sf_dir), viewership_contract())


@query("validate_arrivals")
def _validate_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per arrival; the fourth arrival is empty."""
    contract = actives_contract(work_folder(spark))
    rows = star_schema.actives(spark, sf_dir)
    for number, day in enumerate([*RUN_DAYS, "none"]):
        land(rows.filter(run_day() == day), contract, f"{STAMP}_{number}")
    names = ingest_raw(spark, contract)
    folders = [f"{contract.ingest.destination}/{name}" for name in names]
    tagged = with_arrivals(spark, folders, contract)
    arrivals = spark.createDataFrame([(n,) for n in names], "arrival string")
    return quality.validate_arrivals(scan_zone(spark, folders), arrivals, tagged)


@query("profile_arrivals")
def _profile_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored profiles of three arrivals brought together, and whether they are within their stated error."""
    contract = viewership_contract(work_folder(spark))
    rows = star_schema.viewership(spark, sf_dir)
    store = f"{work_folder(spark)}/profiles"
    columns = ["advertising_id", "channel_name", "duration", "record_timestamp", "user_lat"]
    for number, day in enumerate(RUN_DAYS):
        arrival = land(rows.filter(run_day() == day), contract, f"{STAMP}_{number}")
        landed = scan_zone(spark, f"{contract.ingest.source}/{arrival}", rows.schema)
        profile.store_profile(landed.select(columns), store, arrival)
    merged = profile.summary(profile.merge(profile.stored_profiles(spark, store)))
    return profile.held_against(merged, scan_zone(spark, contract.ingest.source, rows.schema).select(columns))


@query("validate_staging")
def _validate_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract, raw = _staged_actives(spark, sf_dir)
    expected = quality.validate_counts(raw).first()["n_values"]
    staged = scan_staging(spark, contract.transform)
    return quality.validate_staging(staged, contract, "advertising_id", expected)


# --- whole runs --------------------------------------------------------------


@query("run_actives")
def _run_actives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing to lookup in one run; returns the lookup."""
    contract = actives_contract(work_folder(spark))
    land(star_schema.actives(spark, sf_dir), contract, STAMP)
    run_dataset(spark, contract, AS_OF, version=1)
    return LookupStore.of(spark, contract).read()


@query("run_viewership")
def _run_viewership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing to lookup in one run; returns the staging zone."""
    contract = viewership_contract(work_folder(spark))
    land(star_schema.viewership(spark, sf_dir), contract, STAMP)
    run_dataset(spark, contract, AS_OF, version=1)
    return scan_arrivals(spark, contract)


@query("run_arrivals")
def _run_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per arrival, three arrivals; returns the lookup."""
    return LookupStore.of(spark, _arrivals_run(spark, sf_dir)).read()


@query("run_arrivals_staging")
def _run_arrivals_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per arrival, three arrivals; returns the staging zone."""
    return scan_arrivals(spark, _arrivals_run(spark, sf_dir))


@query("run_corrected")
def _run_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last arrival brings the one before it as well, is corrected and run again; returns the staging zone."""
    return scan_arrivals(spark, _corrected_run(spark, sf_dir))


@query("run_corrected_lookup")
def _run_corrected_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``run_corrected``; returns the lookup."""
    return LookupStore.of(spark, _corrected_run(spark, sf_dir)).read()


@query("run_manifest")
def _run_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``run_corrected``; returns what the manifest holds of every arrival."""
    contract = _corrected_run(spark, sf_dir)
    manifest = manifest_of(spark, contract)
    arrivals = [f"{contract.dataset}_{STAMP}_{number}" for number in range(len(RUN_DAYS))]
    rows = [(a, e.folder, e.n_rows, e.n_values) for a in arrivals for e in manifest.entries(a)]
    return spark.createDataFrame(rows, "arrival string, folder string, n_rows long, n_values long")


@query("stream_ingest")
def _stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals as a stream; returns the staging zone."""
    contract = actives_contract(work_folder(spark))
    rows = _stream(spark, star_schema.actives(spark, sf_dir), contract)
    return scan_streamed(spark, contract, rows.schema)


@query("stream_lookup")
def _stream_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three streams in turn on one checkpoint, an arrival each; returns the lookup with its dates."""
    contract = actives_contract(work_folder(spark))
    rows = star_schema.actives(spark, sf_dir)
    for number, day in enumerate(RUN_DAYS):
        land(rows.filter(run_day() == day), contract, f"{STAMP}_{number}")
        # Something else lands beside it, and is left out.
        stage(rows.limit(1), f"{contract.ingest.source}/orders_{number}")
        _start(spark, rows, contract, run_day()).awaitTermination()
    return LookupStore.of(spark, contract).read()


@query("stream_dedup")
def _stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every arrival is delivered again later under another name, across restarts; returns the staging zone."""
    contract = actives_contract(work_folder(spark))
    rows = star_schema.actives(spark, sf_dir)
    once = Once(("event_id",))
    for number, day in enumerate(RUN_DAYS):
        arrived = rows.filter(run_day() <= day) if number else rows.filter(run_day() == day)
        land(arrived, contract, f"{STAMP}_{number}")
        _start(spark, rows, contract, run_day(), once).awaitTermination()
    land(rows, contract, "again")
    _start(spark, rows, contract, run_day(), once).awaitTermination()
    return scan_streamed(spark, contract, rows.schema)


@query("stream_route")
def _stream_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two datasets in one landing zone; one fails at first, and is mended; returns rows of both staging zones."""
    root = work_folder(spark)
    landing = f"{root}/landing/all"
    shapes = {"actives": star_schema.actives(spark, sf_dir), "viewership": star_schema.viewership(spark, sf_dir)}
    routes = [
        Route(contract(root), shapes[name].schema, run_day())
        for name, contract in (("actives", actives_contract), ("viewership", viewership_contract))
    ]
    for number, day in enumerate(RUN_DAYS):
        for name, rows in shapes.items():
            arrived = rows.filter(run_day() == day)
            if name == "viewership" and number == 0:
                arrived = arrived.withColumn(arrived.columns[0], F.lit(None).cast("string"))
            stage(arrived, f"{landing}/{name}_{STAMP}_{number}")
        stage(star_schema.table(spark, sf_dir, "nation"), f"{landing}/orders_{number}")
        stream_route(spark, landing, routes, f"{root}/checkpoint").awaitTermination()
        if number == 0:
            # The arrival that failed is put right under its own name.
            stage(shapes["viewership"].filter(run_day() == day), f"{landing}/viewership_{STAMP}_{number}")
    staged = [scan_streamed(spark, r.contract, r.schema).withColumn("dataset", F.lit(r.contract.dataset)) for r in routes]
    columns = ["dataset", "event_id", "advertising_id", "location_source", F.col("date").cast("string").alias("date")]
    return staged[0].select(columns).unionByName(staged[1].select(columns))


@query("compact_staging")
def _compact_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream compacted in place after every arrival but the last; returns the staging zone."""
    contract = actives_contract(work_folder(spark))
    rows = star_schema.actives(spark, sf_dir)
    for number, day in enumerate(RUN_DAYS):
        land(rows.filter(run_day() == day), contract, f"{STAMP}_{number}")
        _start(spark, rows, contract, run_day()).awaitTermination()
        if day != RUN_DAYS[-1]:
            compact_staging(spark, contract, rows.schema)
            drop_compacted(spark, contract)
    return scan_streamed(spark, contract, rows.schema)


# --- shared inputs -----------------------------------------------------------


def known_until() -> Column:
    """Per row, the date up to which the row's region is known to the lookup."""
    region = F.col("location_granularities")
    until = F.lit(KNOWN_UNTIL_ELSEWHERE)
    for name, day in KNOWN_UNTIL.items():
        until = F.when(region == name, day).otherwise(until)
    return until


def run_day() -> Column:
    """Per row, the ``as_of`` date of the run that brings it."""
    first, second, last = RUN_DAYS
    return F.when(F.col("date") <= first, first).when(F.col("date") <= second, second).otherwise(last)


def week_day() -> Column:
    """Per row, the last day of the date's week; the fourth ends with the month."""
    date = F.col("date")
    return (
        F.when(date <= "2024-01-07", "2024-01-07")
        .when(date <= "2024-01-14", "2024-01-14")
        .when(date <= "2024-01-21", "2024-01-21")
        .otherwise(AS_OF)
    )


def _late_contract(spark: SparkSession, sf_dir: str, order: tuple[int, ...]) -> Contract:
    """A lookup after one run for each of RUN_DAYS, in the given order."""
    contract = actives_contract(work_folder(spark))
    rows = star_schema.actives(spark, sf_dir)
    for version, number in enumerate(order, start=1):
        day = RUN_DAYS[number]
        update_in_any_order(spark, rows.filter(run_day() == day), contract, day, version)
    return contract


def _history(rows: DataFrame, contract: Contract) -> DataFrame:
    """The lookup after one run per date."""
    versions = scd2.scd2_history(
        rows.select(
            *dict.fromkeys([*contract.pii, *contract.tracked, *contract.recency]),
            F.to_date("date").alias("run_date"),
        ),
        contract.keys,
        contract.tracked,
        contract.recency,
        "run_date",
    )
    extra = [c for c in versions.columns if c not in contract.pii]
    return pii.pii_pairs(versions, contract.pii, extra)


def _active_and_batch(spark: SparkSession, sf_dir: str) -> tuple:
    contract = actives_contract()
    lookup, batch = _lookup_and_batch(star_schema.actives(spark, sf_dir), contract)
    return scd2.lookup_active(lookup), batch, contract.keys, contract.tracked


def _lookup_and_batch(rows: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    known = F.col("date") <= known_until()
    return _history(rows.filter(known), contract), lookup_batch(rows.filter(~known), contract)


def _merge(rows: DataFrame, contract: Contract) -> DataFrame:
    lookup, batch = _lookup_and_batch(rows, contract)
    return scd2.scd2_merge(lookup, batch, contract.keys, contract.tracked, AS_OF)


def _staged_actives(spark: SparkSession, sf_dir: str) -> tuple[Contract, DataFrame]:
    contract = actives_contract(work_folder(spark))
    raw = star_schema.actives(spark, sf_dir)
    stage_dataset(raw, contract)
    return contract, raw


def _stored_lookup(spark: SparkSession, sf_dir: str) -> tuple[LookupStore, list[RunCounts]]:
    """A stored lookup after three runs on a raw zone, which together bring all its rows."""
    contract = actives_contract(work_folder(spark))
    stage(star_schema.actives(spark, sf_dir), contract.transform.source)
    rows = scan_zone(spark, contract.transform.source)
    runs = [
        update_lookup(spark, rows.filter(run_day() == day), contract, day, version)
        for version, day in enumerate(RUN_DAYS, start=1)
    ]
    return LookupStore.of(spark, contract), runs


def _arrivals_run(spark: SparkSession, sf_dir: str) -> Contract:
    """Three runs of one arrival each."""
    contract = actives_contract(work_folder(spark))
    rows = star_schema.actives(spark, sf_dir)
    for number, day in enumerate(RUN_DAYS):
        arrival = land(rows.filter(run_day() == day), contract, f"{STAMP}_{number}")
        run_dataset(spark, contract, day, number + 1, arrival)
    return contract


def _corrected_run(spark: SparkSession, sf_dir: str) -> Contract:
    """Three runs of one arrival each; the last first brings all rows, with more dates than it should have."""
    contract = actives_contract(work_folder(spark))
    rows = star_schema.actives(spark, sf_dir)
    last = len(RUN_DAYS) - 1
    for number, day in enumerate([*RUN_DAYS[:last], None, RUN_DAYS[last]]):
        version = min(number, last)
        arrival = land(rows if day is None else rows.filter(run_day() == day), contract, f"{STAMP}_{version}")
        run_dataset(spark, contract, RUN_DAYS[version], version + 1, arrival)
    return contract


def _stream(spark: SparkSession, rows: DataFrame, contract: Contract) -> DataFrame:
    for number, day in enumerate(RUN_DAYS):
        land(rows.filter(run_day() == day), contract, f"{STAMP}_{number}")
    _start(spark, rows, contract, F.to_date("date")).awaitTermination()
    return rows


def _start(spark: SparkSession, rows: DataFrame, contract: Contract, day: Column, once: Once | None = None):
    """A stream over what has landed, all of it in one micro-batch."""
    return stream_ingest(
        spark,
        contract,
        f"{contract.lookup}-checkpoint",
        rows.schema,
        arrival_day=F.to_date(day),
        options={"maxFilesPerTrigger": "1000"},
        once=once,
    )
