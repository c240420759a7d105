"""Arrivals as a file stream: every micro-batch goes through raw, staging and lookup.

``foreachBatch`` may deliver a micro-batch again after a failure, so each of its
three writes replaces exactly what the first delivery wrote: a raw folder per
batch, a last staging partition column holding the batch id, and a lookup run
numbered by the batch id.  The state of the stream is the stored lookup.

A micro-batch passes the gates of a batch run: rows are routed by the name of their
arrival, others are counted and left out, and a failed gate fails the micro-batch
before staging and lookup are touched.

An arrival that is delivered again, under whatever name, is recognised by its rows where
``once`` says which columns make a row: streaming state remembers rows for some time after
they were first seen, and leaves later ones out.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import Row

from zonepipe.contract import Contract
from zonepipe.operators.quality import QualityError, raise_on_failure, validate_columns, validate_raw
from zonepipe.operators.transform import transform
from zonepipe.plans.dataset import REPORT_ONLY
from zonepipe.plans.lookup import update_lookup
from zonepipe.sources.lookup import LookupStore
from zonepipe.sources.zones import PANDAS_INDEX, one_name, route, scan_zone, stage
from zonepipe.streaming.compaction import INGEST_BATCH, scan_batches

_DAY, _DATASET, _SEEN = "_arrival_day", "_dataset", "_first_seen"

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Once:
    """Rows that agree in ``columns`` are taken once, as long as the first was seen within ``within``.

    Time is that of the micro-batch, so no row is ever too late to be taken, whatever its own
    dates say; a micro-batch that is repeated has the same time.  State grows with the rows of
    ``within``, spread by their columns; a store outside the heap, as Spark's RocksDB one, suits it.
    Without ``columns``, whole rows count, their arrival's name aside.
    """

    columns: tuple[str, ...] = ()
    within: str = "30 days"


@dataclass(frozen=True)
class BatchReport:
    """What one micro-batch brought: rows left out by name, and every check."""

    batch_id: int
    rows: int
    unrouted: int
    checks: list[Row] = field(default_factory=list)


def stream_ingest(
    spark: SparkSession,
    contract: Contract,
    checkpoint: str,
    schema: T.StructType | None = None,
    arrival_day: Column | None = None,
    options: dict[str, str] | None = None,
    strict: bool = False,
    pepper: str | None = None,
    report: Callable[[BatchReport], None] | None = None,
    once: Once | None = None,
) -> StreamingQuery:
    """Start a stream that processes what has landed and then stops.

    ``schema`` is the landed rows' schema (read from landed files if not given).
    ``arrival_day`` is the date versions of a micro-batch begin on, its maximum
    over the batch: a function of the data, never of the clock.  By default it is
    the day the files arrived.  Where it lies before an earlier micro-batch's day, that
    day counts, as versions begin in the order of runs.  ``options`` go to the file
    source, for example ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``.  ``report`` is
    called with each micro-batch's report.  With ``once``, rows delivered again are left out;
    a checkpoint is used with it or without it, not in turn.
    """
    step = contract.ingest
    if schema is None:
        schema = scan_zone(spark, step.source, file_format=step.source_format).schema
    landed = (
        spark.readStream.format(step.source_format)
        .schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{step.source_format}")
        .options(**(options or {}))
        .load(step.source)
        .drop(PANDAS_INDEX)
    )
    if arrival_day is None:
        arrival_day = F.to_date(F.col("_metadata.file_modification_time"))
    _, dataset = route(F.col("_metadata.file_path"), [contract.dataset])
    dated = landed.select("*", arrival_day.alias(_DAY), dataset.alias(_DATASET))
    if once:
        columns = list(once.columns) or landed.columns
        timed = dated.withColumn(_SEEN, F.current_timestamp()).withWatermark(_SEEN, once.within)
        # Rows of other datasets do not stand in for those of this one.
        dated = timed.dropDuplicatesWithinWatermark([*columns, _DATASET]).drop(_SEEN)

    def process(batch: DataFrame, batch_id: int) -> None:
        done = process_batch(batch, batch_id, contract, strict, pepper)
        if report:
            report(done)

    return (
        dated.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def process_batch(
    batch: DataFrame, batch_id: int, contract: Contract, strict: bool = False, pepper: str | None = None
) -> BatchReport:
    """One micro-batch.  Later steps read the raw copy, pruned to their columns."""
    session = batch.sparkSession
    step = contract.transform
    folder = f"{contract.ingest.destination}/stream-{batch_id}"
    if _DATASET not in batch.columns:
        batch = batch.withColumn(_DATASET, F.lit(contract.dataset))
    seen = Observation()
    own = F.col(_DATASET) == contract.dataset
    counted = batch.observe(
        seen, F.max(F.when(own, F.col(_DAY))).alias("day"), F.count_if(own).alias("n"), F.count_if(~own).alias("unrouted")
    )
    plain = counted.filter(own).drop(_DAY, _DATASET)
    stage(plain, folder, file_format=contract.ingest.destination_format)
    n, unrouted = seen.get.get("n") or 0, seen.get.get("unrouted") or 0
    if unrouted:
        log.warning("micro-batch %d left out %d rows of arrivals not named after %s", batch_id, unrouted, contract.dataset)
    if not n:
        return BatchReport(batch_id, 0, unrouted)
    schema = batch.drop(_DAY, _DATASET).schema
    raw = one_name(scan_zone(session, folder, schema, contract.ingest.destination_format), step.rename)
    if missing := validate_columns(raw, contract):
        raise QualityError(f"columns missing from the data: {missing}")
    checks = raise_on_failure(validate_raw(raw, contract), REPORT_ONLY)
    for check in checks:
        if not check["passed"]:
            log.warning("micro-batch %d: %s(%s) is %s", batch_id, check["check"], check["subject"], check["actual"])
    finest = step.partitions[-1] if step.partitions else None
    rows = transform(raw, contract, strict, pepper, spread_by=finest)
    stage(
        rows.withColumn(INGEST_BATCH, F.lit(batch_id)),
        step.destination,
        [*step.partitions, INGEST_BATCH],
        rebalance=False,
        overwrite="dynamic",
        file_format=step.destination_format,
    )
    version = batch_id + 1
    day = max(str(seen.get["day"]), LookupStore.of(session, contract).latest_day(before=version) or "")
    update_lookup(session, raw, contract, day, version, pepper, feed="stream")
    return BatchReport(batch_id, n, unrouted, checks)


def scan_streamed(spark: SparkSession, contract: Contract, raw_schema: T.StructType) -> DataFrame:
    """The staging zone a stream has written, compacted or not, without the batch id."""
    return scan_batches(spark, contract, raw_schema)


def compact_streamed(spark: SparkSession, contract: Contract, raw_schema: T.StructType, destination: str) -> None:
    """Copy a streamed staging zone to ``destination`` in few large files per partition.

    The stream writes a folder per partition and micro-batch, which it may have to replace;
    this is for readers of what is finished.  It may run beside the stream and is repeated
    as a whole.
    """
    step = contract.transform
    rows = scan_streamed(spark, contract, raw_schema)
    stage(rows, destination, step.partitions, file_format=step.destination_format)
