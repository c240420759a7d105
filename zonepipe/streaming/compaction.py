"""Small files of a streamed staging zone, gathered where they are.

``<zone>/…/ingest_batch=N/``                     what micro-batch N has written
``<zone>/_compacted/from=A/upto=B/…``            rows of batches A to B, few files per partition
``<zone>/_compacted/from=A/upto=B/_published``   written last; without it readers pass the range over

Readers list the published ranges, follow them from batch 0 on, the longest of those that
begin alike, and take the folders of later batches as they are.  A compaction gathers what
came since the last one, so its cost follows the new rows; a ``whole`` one gathers all.  It
covers batches whose lookup run is committed, the last thing a batch does, so it may run
beside the stream; a batch delivered again after that is passed over by readers.  One
compaction at a time.  What a published range replaces stays until ``drop_compacted``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepipe.contract import Contract
from zonepipe.operators.quality import QualityError
from zonepipe.operators.transform import staged_schema
from zonepipe.sources.files import glob, remove, touch
from zonepipe.sources.lookup import LookupStore
from zonepipe.sources.zones import stage

INGEST_BATCH = "ingest_batch"


@dataclass(frozen=True, order=True)
class Range:
    """The rows of batches ``first`` to ``last`` at ``path``."""

    first: int
    last: int
    path: str


def ranges(spark: SparkSession, zone: str, published: bool = True) -> list[Range]:
    """All ranges of a zone, also those still being written if not only ``published`` ones."""
    pattern = f"{zone}/_compacted/from=*/upto=*"
    found = glob(spark, f"{pattern}/_published" if published else pattern)
    paths = [p.removesuffix("/_published") for p in found]
    return sorted(Range(*map(int, re.search(r"/from=(\d+)/upto=(\d+)$", p).groups()), p) for p in paths)


def current(spark: SparkSession, zone: str) -> list[Range]:
    """The published ranges that readers take, in order and without gaps from batch 0 on."""
    chain: list[Range] = []
    longest = {r.first: r for r in ranges(spark, zone)}  # Sorted, so the longest comes last.
    while (at := chain[-1].last + 1 if chain else 0) in longest:
        chain.append(longest[at])
    return chain


def scan_batches(
    spark: SparkSession, contract: Contract, raw_schema: T.StructType, first: int = 0, last: int | None = None
) -> DataFrame:
    """Staged rows of batches ``first`` to ``last``, no range reaching across the borders, without the batch id."""
    step = contract.transform
    plain = staged_schema(raw_schema, contract)
    chain = [r for r in current(spark, step.destination) if r.first >= first]
    begin = chain[-1].last + 1 if chain else first
    live = spark.read.format(step.destination_format)
    live = live.schema(T.StructType([*plain.fields, T.StructField(INGEST_BATCH, T.LongType())])).load(step.destination)
    if begin:
        live = live.filter(F.col(INGEST_BATCH) >= begin)
    if last is not None:
        live = live.filter(F.col(INGEST_BATCH) <= last)
    gathered = [spark.read.format(step.destination_format).schema(plain).load(r.path) for r in chain]
    return reduce(DataFrame.unionByName, gathered, live.drop(INGEST_BATCH))


def compact_staging(
    spark: SparkSession, contract: Contract, raw_schema: T.StructType, whole: bool = False
) -> Range | None:
    """Gather finished batches in few files per partition; the new range, or None if nothing came since.

    Rows are rebalanced by the finest partition column: adaptive execution packs small
    partitions together and splits large ones.  A run that dies leaves an unpublished range,
    which readers pass over and the next run replaces.
    """
    step = contract.transform
    chain = current(spark, step.destination)
    first = chain[-1].last + 1 if chain and not whole else 0
    last = max(LookupStore.of(spark, contract).versions(), default=0) - 1
    if last < first or (whole and len(chain) == 1 and chain[0].last == last):
        return None
    rows = scan_batches(spark, contract, raw_schema, first, last)
    new = Range(first, last, f"{step.destination}/_compacted/from={first}/upto={last}")
    stage(rows, new.path, step.partitions, file_format=step.destination_format)
    written = spark.read.format(step.destination_format).schema(staged_schema(raw_schema, contract)).load(new.path)
    expected, found = rows.count(), written.count()
    if expected != found:
        raise QualityError(f"compaction: expected {expected} rows in {new.path}, got {found}")
    touch(spark, f"{new.path}/_published")
    return new


def drop_compacted(spark: SparkSession, contract: Contract) -> list[str]:
    """Remove folders that a published range has replaced, and ranges that no reader takes; returns them.

    For a time when nothing reads or compacts the zone as it was before.
    """
    step = contract.transform
    chain = current(spark, step.destination)
    if not chain:
        return []
    taken = {(r.first, r.last) for r in chain}
    stale = [r.path for r in ranges(spark, step.destination, published=False) if (r.first, r.last) not in taken]
    levels = "/".join([*[f"{p}=*" for p in step.partitions], f"{INGEST_BATCH}=*"])
    for path in glob(spark, f"{step.destination}/{levels}"):
        if int(path.rsplit("=", 1)[1]) <= chain[-1].last:
            stale.append(path)
    for path in stale:
        remove(spark, path)
    return stale
