"""One stream over a landing zone that several datasets share.

The source lists landing once and streams files, not rows: a file's content is read by the
dataset that its arrival is named after, with that dataset's columns, so arrivals of any
shape may lie side by side.  Every micro-batch is dealt to the datasets it brings files of,
and passes each one's gates, raw and staging zone and lookup on its own, as ``process_batch``
has them.

A dataset that fails does not stop the others.  Its files of that micro-batch are put aside
under ``<pending>/dataset=D/batch=N`` and tried again, in order, before anything later of the
dataset is: with its next files, or when the stream is started again.  What has been put aside
and is mended in landing, under the same name or as a new arrival, is read as it is by then;
files that are gone are left out, and a micro-batch of which none is left is dropped.

All writes of a dataset are numbered by the micro-batch, so a crash at any point repeats what
was being done: a micro-batch that is delivered again replaces its own output, and one that
was put aside leaves the list only after its lookup run is committed.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from zonepipe.contract import Contract
from zonepipe.sources.files import glob, literal, remove
from zonepipe.sources.lookup import LookupStore
from zonepipe.sources.zones import UNROUTED, route, scan_zone
from zonepipe.streaming.compaction import INGEST_BATCH
from zonepipe.streaming.ingest import _DATASET, _DAY, BatchReport, process_batch

#: Files of a micro-batch unless the caller says otherwise; their names go through the driver.
MAX_FILES = 10_000
#: Columns of Spark's scan of whole files.
FILE = "path string, modificationTime timestamp, length long, content binary"

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class RouteReport:
    """What a micro-batch brought: each dataset's reports, its error, and files of no dataset.

    ``done`` has the reports of batches put aside earlier as well, ``errors`` what stopped a dataset.
    """

    batch_id: int | None
    unrouted: int = 0
    done: dict[str, list[BatchReport]] = field(default_factory=dict)
    errors: dict[str, Exception] = field(default_factory=dict)


@dataclass(frozen=True)
class Route:
    """A contract, the columns of its landed rows and the date its versions begin on.

    Without ``schema`` the footers of a micro-batch's files are merged; without
    ``arrival_day`` the day that the files arrived counts.
    """

    contract: Contract
    schema: T.StructType | None = None
    arrival_day: Column | None = None
    strict: bool = False
    pepper: str | None = None


class Pending:
    """Files of micro-batches that a dataset has still to take."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def batches(self, dataset: str) -> list[int]:
        """Micro-batches put aside, oldest first."""
        found = glob(self.spark, f"{self.path}/dataset={dataset}/batch=*/_SUCCESS")
        return sorted(int(re.search(r"/batch=(\d+)/_SUCCESS$", p)[1]) for p in found)

    def files(self, dataset: str, batch_id: int) -> list[str]:
        """Files of one that are still there."""
        rows = self.spark.read.schema("path string").parquet(self._at(dataset, batch_id)).collect()
        return [r["path"] for r in rows if glob(self.spark, literal(r["path"]))]

    def put(self, dataset: str, batch_id: int, files: Sequence[str]) -> None:
        rows = self.spark.createDataFrame([(f,) for f in files], "path string")
        rows.coalesce(1).write.mode("overwrite").parquet(self._at(dataset, batch_id))

    def drop(self, dataset: str, batch_id: int) -> None:
        remove(self.spark, self._at(dataset, batch_id))

    def _at(self, dataset: str, batch_id: int) -> str:
        return f"{self.path}/dataset={dataset}/batch={batch_id}"


def stream_route(
    spark: SparkSession,
    landing: str,
    routes: Sequence[Route],
    checkpoint: str,
    options: Mapping[str, str] | None = None,
    report: Callable[[RouteReport], None] | None = None,
    pending: str | None = None,
) -> StreamingQuery:
    """Start a stream that deals what has landed to its datasets and then stops.

    Before it starts, each dataset tries again what was put aside, by default next to the
    ``checkpoint``.  ``report`` is called for that (without a batch id) and for every
    micro-batch; a dataset's error is logged and reported, not raised.
    """
    by_name = {r.contract.dataset: r for r in routes}
    formats = {r.contract.ingest.source_format for r in routes}
    aside = Pending(spark, pending or f"{checkpoint.rstrip('/')}-pending")
    tell = report or (lambda _: None)

    again = RouteReport(None)
    for name in sorted(by_name):
        _take(spark, by_name[name], aside, again)
    if again.done or again.errors:
        tell(again)

    # One row per file; the column that holds its content is not selected and so not read.
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{{{','.join(sorted(formats))}}}")
        .options(**{"maxFilesPerTrigger": str(MAX_FILES), **(options or {})})
        .load(landing)
        .select("path")
    )

    def process(batch: DataFrame, batch_id: int) -> None:
        tell(deal(batch, batch_id, by_name, aside))

    return (
        files.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def deal(batch: DataFrame, batch_id: int, routes: Mapping[str, Route], aside: Pending) -> RouteReport:
    """One micro-batch of files, given as ``path``."""
    _, dataset = route(F.col("path"), routes)
    brought: dict[str, list[str]] = {}
    for row in batch.select("path", dataset).collect():  # names of at most maxFilesPerTrigger files
        brought.setdefault(row["dataset"], []).append(row["path"])
    report = RouteReport(batch_id, len(brought.pop(UNROUTED, [])))
    if report.unrouted:
        log.warning("micro-batch %d left out %d files of no known dataset", batch_id, report.unrouted)
    for name in sorted(brought):
        _take(batch.sparkSession, routes[name], aside, report, batch_id, sorted(brought[name]))
    return report


def _take(
    spark: SparkSession,
    way: Route,
    aside: Pending,
    report: RouteReport,
    batch_id: int | None = None,
    files: Sequence[str] = (),
) -> None:
    """What was put aside, oldest first, then the files of this micro-batch; up to the first that fails."""
    name = way.contract.dataset
    try:
        for number in [n for n in aside.batches(name) if n != batch_id]:
            # It may have got as far as its lookup run, and died before it left the list.
            if number + 1 not in LookupStore.of(spark, way.contract).versions():
                _clear(spark, way.contract, number)
                if found := aside.files(name, number):
                    done = _process(spark, way, number, found)
                    report.done.setdefault(name, []).append(done)
            aside.drop(name, number)
        if files:
            done = _process(spark, way, batch_id, files)
            report.done.setdefault(name, []).append(done)
            aside.drop(name, batch_id)
    except Exception as error:
        # Whatever it is, the dataset's files are kept, and the other datasets go on.
        log.exception("dataset %s stops before micro-batch %s", name, batch_id)
        report.errors[name] = error
        if files:
            aside.put(name, batch_id, files)


def _clear(spark: SparkSession, contract: Contract, batch_id: int) -> None:
    """Remove what a try that failed has written: the files it is repeated with may be others."""
    step = contract.transform
    levels = "/".join([*[f"{p}=*" for p in step.partitions], f"{INGEST_BATCH}={batch_id}"])
    for path in [f"{contract.ingest.destination}/stream-{batch_id}", *glob(spark, f"{step.destination}/{levels}")]:
        remove(spark, path)


def _process(spark: SparkSession, way: Route, batch_id: int, files: Sequence[str]) -> BatchReport:
    step, paths = way.contract.ingest, [literal(f) for f in files]
    rows = scan_zone(spark, paths, way.schema, step.source_format, None if way.schema else way.contract.transform)
    day = way.arrival_day
    if day is None:
        arrived = spark.read.format("binaryFile").load(paths).agg(F.max(F.to_date("modificationTime"))).first()[0]
        day = F.lit(arrived)
    own = rows.select("*", F.to_date(day).alias(_DAY), F.lit(way.contract.dataset).alias(_DATASET))
    return process_batch(own, batch_id, way.contract, way.strict, way.pepper)
