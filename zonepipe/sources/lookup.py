"""Stored lookup: one folder of changes per run, and snapshots made on request.

``<path>/v=N/as_of=D/change=opened``  versions run N opened
``<path>/v=N/as_of=D/change=closed``  versions run N closed
``<path>/v=N/as_of=D/change=seen``    the batch of run N, kept where late batches are to be spliced in
``<path>/v=N/as_of=D/change=spliced``  ended versions that a late batch made; they were never open
``<path>/v=N/as_of=D/change=dropped_open``, ``=dropped_closed``  versions of earlier runs that a
                                      late batch has replaced
``<path>/v=N/as_of=D/_SUCCESS``       written last by Spark's committer; without it run N does not count
``<path>/snapshots/v=N``              all open versions after run N, with a ``_SUCCESS`` of its own,
                                      bucketed by key; ``_buckets_B`` beside it says by how many

Every run is committed, one that changes nothing with no data at all.  Open versions
are the newest snapshot's and those opened since, less those closed since; a version is
known by its key and the run that opened it.  History is what all runs closed or spliced in,
less what late batches have dropped.  Readers list the folders once and work from that list.

A snapshot's files are dealt and sorted by key, and read as a bucketed table: a join on the
key needs no exchange on the snapshot's side, however large it is.  Changes since are
small and are not bucketed.  The catalog entry that Spark needs for buckets lives for one
statement only.

Repeating the newest run replaces its folder, computed from the same older input; a
snapshot of the replaced run goes first.  Dates of runs never go back.  One writer at a
time, and either batch runs or a stream, which the first run settles.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepipe.contract import Contract
from zonepipe.functions import parse_type
from zonepipe.operators.pii import ACTIVE, BEGIN, MASKED_PREFIX, UPDATE
from zonepipe.sources.files import glob, remove, touch

OPENED, CLOSED, SEEN, SPLICED = "opened", "closed", "seen", "spliced"
DROPPED_OPEN, DROPPED_CLOSED = "dropped_open", "dropped_closed"
CHANGE = "change"
#: Stored beside the lookup's columns: the run that opened a version.
OPENED_IN = "_opened_in"
FEEDS = ("batch", "stream")
#: Rows of a snapshot that go into one bucket, some 500 MB of identifiers and masks.
BUCKET_ROWS = 4_000_000
LEAST_BUCKETS = 8


class StaleRun(Exception):
    """A newer run has been committed already, or the run's date lies before an earlier run's."""


class WrongFeed(Exception):
    """A lookup fed by batch runs is given a stream, or the other way round."""


def lookup_schema(contract: Contract) -> T.StructType:
    """Columns of the stored lookup in order.

    Identifiers and whatever the contract does not cast are text.
    """
    pairs = [name for c in contract.pii for name in (c, MASKED_PREFIX + c)]
    fields = [T.StructField(c, T.StringType()) for c in pairs]
    fields += [T.StructField(c, stored_type(c, contract)) for c in lookup_extra(contract)]
    fields += [
        T.StructField(BEGIN, T.DateType()),
        T.StructField(UPDATE, T.DateType()),
        T.StructField(ACTIVE, T.BooleanType()),
    ]
    return T.StructType(fields)


def lookup_extra(contract: Contract) -> list[str]:
    """Key and tracked columns that are no identifiers."""
    return [c for c in dict.fromkeys([*contract.keys, *contract.tracked]) if c not in contract.pii]


def stored_type(column: str, contract: Contract) -> T.DataType:
    casts = contract.transform.casts
    return parse_type(casts[column]) if column in casts else T.StringType()


@dataclass(frozen=True)
class Listing:
    """What one look at a lookup's folders has found."""

    #: Committed runs and their dates.
    runs: dict[int, str] = field(default_factory=dict)
    #: Folders of changes of committed runs.
    changes: dict[tuple[int, str], str] = field(default_factory=dict)
    snapshots: dict[int, str] = field(default_factory=dict)
    #: Buckets of snapshots that have them.
    buckets: dict[int, int] = field(default_factory=dict)


def write_bucketed(rows: DataFrame, folder: str, keys: Sequence[str], n: int) -> None:
    """Write ``rows`` to an empty folder in ``n`` buckets of their keys, one file each, sorted."""
    spark, name = rows.sparkSession, f"zonepipe_{uuid.uuid4().hex}"
    dealt = rows.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys)
    try:
        dealt.option("path", folder).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").saveAsTable(name)
    finally:
        spark.sql(f"drop table if exists {name}")


def read_bucketed(spark: SparkSession, schema: T.StructType, folder: str, keys: Sequence[str], n: int) -> DataFrame:
    """A scan of what ``write_bucketed`` has written that knows its buckets."""
    name = f"zonepipe_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"create table {name} ({columns}) using parquet clustered by ({by}) sorted by ({by}) into {n} buckets "
        f"location '{folder.replace(chr(39), chr(92) + chr(39))}'"
    )
    try:
        return spark.table(name)
    finally:
        spark.sql(f"drop table {name}")


class LookupStore:
    """Reads and writes the folders of one dataset's lookup."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: tuple[str, ...] = (), buckets: int | None = None
    ):
        """``buckets`` of snapshots follow from their rows if not given."""
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys = list(keys or schema.names[:1])
        self.buckets = buckets

    @staticmethod
    def of(spark: SparkSession, contract: Contract) -> LookupStore:
        return LookupStore(spark, contract.lookup, lookup_schema(contract), contract.keys)

    def listing(self) -> Listing:
        found = Listing()
        paths = glob(self.spark, f"{self.path}/{{v=*/as_of=*/*,snapshots/v=*/_*}}")
        for path in paths:
            if m := re.search(r"/snapshots/v=(\d+)/_SUCCESS$", path):
                found.snapshots[int(m[1])] = path.removesuffix("/_SUCCESS")
            elif m := re.search(r"/snapshots/v=(\d+)/_buckets_(\d+)$", path):
                found.buckets[int(m[1])] = int(m[2])
            elif m := re.search(r"/v=(\d+)/as_of=([\d-]+)/_SUCCESS$", path):
                found.runs[int(m[1])] = m[2]
        for path in paths:
            m = re.search(rf"/v=(\d+)/as_of=([\d-]+)/{CHANGE}=(\w+)$", path)
            if m and found.runs.get(int(m[1])) == m[2]:
                found.changes[int(m[1]), m[3]] = path
        for version in [v for v in found.snapshots if v not in found.runs]:
            del found.snapshots[version]
        return found

    def versions(self) -> list[int]:
        """Committed runs, oldest first."""
        return sorted(self.listing().runs)

    def active(self, before: int | None = None) -> DataFrame:
        """Open versions after the newest run (older than ``before``)."""
        return self._active(self.listing(), before).drop(OPENED_IN)

    def active_to_change(self, before: int) -> DataFrame:
        """``active`` with the run that opened each version."""
        return self._active(self.listing(), before)

    def open_parts(self, before: int) -> tuple[list[DataFrame], DataFrame | None]:
        """``active_to_change`` as stored: parts of it, and the keys and runs of versions in them that are closed.

        A join on the key may go to each part by itself, the bucketed snapshot staying where
        it is, and closed versions be removed from what was found.
        """
        return self._parts(self.listing(), before)

    def closed(self) -> DataFrame:
        """Versions that runs have closed."""
        return self._closed(self.listing()).drop(OPENED_IN)

    def read(self) -> DataFrame:
        """The whole lookup, from one listing."""
        now = self.listing()
        return self._active(now).unionByName(self._closed(now)).drop(OPENED_IN)

    def versions_before(self, before: int) -> DataFrame:
        """Open and closed versions after the newest run older than ``before``, with the run that wrote each."""
        now = self.listing()
        return self._active(now, before).unionByName(self._closed(now, before))

    def seen(self, before: int) -> DataFrame:
        """Batches kept by runs older than ``before``: their rows, dated by ``begin_date``."""
        now = self.listing()
        return self._load(self._folders(now, SEEN, before), active=True)

    def keeps_batches(self, before: int) -> bool:
        """Whether every run older than ``before`` that could keep its batch has kept it."""
        now = self.listing()
        return all((v, SEEN) in now.changes for v in now.runs if v < before)

    def check_order(self, version: int, as_of: dt.date | str, late: bool = False) -> None:
        """Refuse a run older than the newest, and unless it is ``late`` one of an earlier date."""
        runs = self.listing().runs
        newer = [v for v in runs if v > version]
        if newer:
            raise StaleRun(f"run {version} comes after committed run {max(newer)} of {self.path}")
        later = [d for v, d in runs.items() if v < version and d > str(as_of)]
        if later and not late:
            raise StaleRun(f"run {version} of {as_of} lies before a committed run of {max(later)} in {self.path}")

    def latest_day(self, before: int) -> str | None:
        """The date of the last run older than ``before``."""
        return max((d for v, d in self.listing().runs.items() if v < before), default=None)

    def claim(self, feed: str) -> None:
        """Settle who feeds the lookup; refuse if it has been settled otherwise."""
        others = [f for f in FEEDS if f != feed]
        if taken := glob(self.spark, f"{self.path}/_fed_by_{{{','.join(others)}}}"):
            raise WrongFeed(f"{self.path} is fed by {taken[0].rsplit('_', 1)[1]}, not by {feed}")
        touch(self.spark, f"{self.path}/_fed_by_{feed}")

    def write(self, changes: DataFrame, version: int, as_of: dt.date | str, late: bool = False) -> None:
        """Commit one run: ``changes`` are lookup rows with OPENED_IN and, if they have it, CHANGE.

        Without, open ones are what the run opened, others what it closed.
        """
        self.check_order(version, as_of, late)
        target = f"{self.path}/v={version}/as_of={as_of}"
        for path in glob(self.spark, f"{self.path}/{{snapshots/v={version},v={version}/as_of=*}}"):
            if not path.endswith(target):
                remove(self.spark, path)
        if CHANGE not in changes.columns:
            changes = changes.withColumn(CHANGE, F.when(F.col(ACTIVE), OPENED).otherwise(CLOSED))
        (
            changes.drop(ACTIVE)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
            .partitionBy(CHANGE)
            .parquet(target)
        )

    def compact(self) -> int | None:
        """Write all open versions after the newest run as a snapshot; the run's number."""
        now = self.listing()
        if not now.runs:
            return None
        version = max(now.runs)
        if version not in now.snapshots:
            rows = self._active(now).drop(ACTIVE)
            n = self.buckets or max(LEAST_BUCKETS, -(-rows.count() // BUCKET_ROWS))
            folder = f"{self.path}/snapshots/v={version}"
            remove(self.spark, folder)
            write_bucketed(rows, folder, self.keys, n)
            touch(self.spark, f"{folder}/_buckets_{n}")
        return version

    def drop_superseded(self) -> list[str]:
        """Remove what a snapshot has taken the place of; history stays whole.

        The snapshot has to be older than the newest run, which may have to be repeated.
        """
        now = self.listing()
        usable = [v for v in now.snapshots if v < max(now.runs)] if now.runs else []
        if not usable:
            return []
        base = max(usable)
        gone = [p for v, p in now.snapshots.items() if v < base]
        gone += [p for (v, change), p in now.changes.items() if v <= base and change == OPENED]
        for path in gone:
            remove(self.spark, path)
        return gone

    def empty(self) -> DataFrame:
        """A lookup without rows, as a plan the optimizer knows to be empty."""
        columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in self._stored().fields]
        rows = self.spark.range(1).select(*columns, F.lit(True).alias(ACTIVE))
        return rows.select(*self.schema.names, OPENED_IN).filter(F.lit(False))

    def _active(self, now: Listing, before: int | None = None) -> DataFrame:
        parts, gone = self._parts(now, before)
        rows = reduce(DataFrame.unionByName, parts)
        if gone is None:
            return rows
        return rows.join(gone, [*self.keys, OPENED_IN], "left_anti").select(*self.schema.names, OPENED_IN)

    def _parts(self, now: Listing, before: int | None) -> tuple[list[DataFrame], DataFrame | None]:
        runs = [v for v in now.runs if before is None or v < before]
        base = max((v for v in now.snapshots if v in runs), default=None)
        since = [v for v in runs if base is None or v > base]
        parts = [self._snapshot(now, base)] if base is not None else []
        folders = [now.changes[v, OPENED] for v in since if (v, OPENED) in now.changes]
        if folders or not parts:
            parts.append(self._load(folders, active=True))
        ended = [now.changes[v, c] for v in since for c in (CLOSED, DROPPED_OPEN) if (v, c) in now.changes]
        return parts, self._load(ended, active=False).select(*self.keys, OPENED_IN) if ended else None

    def _snapshot(self, now: Listing, version: int) -> DataFrame:
        folder = now.snapshots[version]
        if version not in now.buckets:
            return self._load([folder], active=True)
        rows = read_bucketed(self.spark, self._stored(), folder, self.keys, now.buckets[version])
        return rows.withColumn(ACTIVE, F.lit(True)).select(*self.schema.names, OPENED_IN)

    def _closed(self, now: Listing, before: int | None = None) -> DataFrame:
        rows = self._load(self._folders(now, CLOSED, before) + self._folders(now, SPLICED, before), active=False)
        dropped = self._folders(now, DROPPED_CLOSED, before)
        if not dropped:
            return rows
        version = [*self.keys, OPENED_IN, BEGIN]
        gone = self._load(dropped, active=False).select(*version)
        return rows.join(gone, version, "left_anti").select(*self.schema.names, OPENED_IN)

    def _folders(self, now: Listing, change: str, before: int | None) -> list[str]:
        return [path for (v, c), path in now.changes.items() if c == change and (before is None or v < before)]

    def _stored(self) -> T.StructType:
        kept = [f for f in self.schema.fields if f.name != ACTIVE]
        return T.StructType([*kept, T.StructField(OPENED_IN, T.LongType())])

    def _load(self, folders: list[str], active: bool) -> DataFrame:
        if not folders:
            return self.empty()
        rows = self.spark.read.schema(self._stored()).option("recursiveFileLookup", "true").parquet(*folders)
        return rows.withColumn(ACTIVE, F.lit(active)).select(*self.schema.names, OPENED_IN)
