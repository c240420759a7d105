"""A whole batch run of one dataset: landing → raw → staging, checks, lookup."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import Row

from zonepipe.contract import Contract, ZoneStep
from zonepipe.functions import cast_to
from zonepipe.operators.quality import (
    QualityError,
    raise_on_failure,
    validate_arrivals,
    validate_columns,
    validate_raw,
    validate_staging,
)
from zonepipe.operators.transform import transform
from zonepipe.plans.lookup import RunCounts, update_lookup
from zonepipe.sources.manifest import ARRIVAL, Manifest, SchemaDrift, count_folders, plain_path
from zonepipe.sources.verbatim import ingest_bytes
from zonepipe.sources.zones import (
    arrival_name,
    arrivals_in,
    ingest_raw,
    scan_staging,
    scan_zone,
    stage,
    staging_schema,
    stored_rows,
)

# Checks that are reported but do not stop a run.
REPORT_ONLY = ("cast_loss", "null_key")


@dataclass(frozen=True)
class RunReport:
    """Outcome of one run: every check, and what happened to the lookup."""

    dataset: str
    lookup: RunCounts
    checks: list[Row] = field(default_factory=list)


def run_dataset(
    spark: SparkSession,
    contract: Contract,
    as_of: dt.date | str,
    version: int,
    arrival: str | None = None,
    strict: bool = False,
    pepper: str | None = None,
    verbatim: bool = False,
) -> RunReport:
    """Ingest, check, transform, stage, check again, and update the lookup.

    With ``arrival`` every step handles that arrival and nothing else: staging has the
    arrival as its last partition column, and the arrival's partitions are replaced, those
    that a corrected arrival no longer has included.  Without, all landed arrivals are
    ingested and the run covers the whole raw zone.  A failed gate stops the run before the
    lookup is touched.  Every step replaces its own output, so a run that died, or whose
    arrival was corrected, may simply be repeated with the same ``version``.  ``verbatim``
    copies landed files byte by byte and compares their digests.
    """
    step = contract.transform
    names = (ingest_bytes if verbatim else ingest_raw)(spark, contract, arrival)
    if arrival is None:
        names = [arrival_name(p) for p in arrivals_in(spark, contract.ingest.destination)]
    folders = [f"{contract.ingest.destination}/{name}" for name in names]
    raw = scan_zone(spark, folders, file_format=step.source_format, step=step)
    tagged = with_arrivals(spark, folders, contract)
    checks = check_raw(spark, raw, contract, names, tagged)
    stage_arrivals(tagged, contract, strict, pepper, arrival)
    with read_back(spark, raw.columns[0], contract, names) as staged:
        checks += check_staging(spark, raw.columns[0], contract, names, checks, staged)
        record_arrivals(spark, contract, staged, arrival)
    counts = update_lookup(spark, raw, contract, as_of, version, pepper)
    return RunReport(contract.dataset, counts, checks)


def with_arrivals(spark: SparkSession, folders: list[str], contract: Contract) -> DataFrame:
    """Raw rows with the arrival they came in, named by its folder."""
    step = contract.transform
    rows = scan_zone(spark, folders, file_format=step.source_format, step=step)
    if len(folders) == 1:
        return rows.withColumn(ARRIVAL, F.lit(arrival_name(folders[0])))
    return rows.withColumn(ARRIVAL, F.element_at(F.split(plain_path(F.input_file_name()), "/"), -2))


def stage_arrivals(
    tagged: DataFrame, contract: Contract, strict: bool = False, pepper: str | None = None, arrival: str | None = None
) -> None:
    """Transform rows and write them to staging, replacing all there is of their arrival.

    Without ``arrival`` the rows are all there are, and replace the zone.
    """
    step = contract.transform
    finest = step.partitions[-1] if step.partitions else ARRIVAL
    rows = transform(tagged, contract, strict, pepper, spread_by=finest)
    if arrival is not None:
        manifest_of(tagged.sparkSession, contract).make_way(arrival, transform(tagged, contract, strict, pepper))
    stage(
        rows,
        step.destination,
        [*step.partitions, ARRIVAL],
        rebalance=False,
        overwrite="static" if arrival is None else "dynamic",
        file_format=step.destination_format,
    )


def manifest_of(spark: SparkSession, contract: Contract) -> Manifest:
    return Manifest(spark, contract.transform.destination, contract.transform.partitions)


def by_arrival(contract: Contract) -> ZoneStep:
    """The step to staging as runs write it, the arrival being the last partition column."""
    return replace(contract.transform, partitions=(*contract.transform.partitions, ARRIVAL))


@dataclass(frozen=True)
class Staged:
    """What was read back of staging: a row for each folder, and the columns its files agree on."""

    counted: DataFrame
    stored: T.StructType


@contextmanager
def read_back(spark: SparkSession, column: str, contract: Contract, names: list[str]) -> Iterator[Staged]:
    """Read the arrivals ``names`` back from staging, for all that is to be known of them.

    Their files are listed once, their footers merged and their rows counted by folder, which
    is kept for as long as it is needed.  The folders of one arrival come from the manifest.
    ``column`` is the first of the raw zone.
    """
    step = contract.transform
    entries = manifest_of(spark, contract).entries(names[0]) if len(names) == 1 else []
    paths = [f"{step.destination}/{e.folder}" for e in entries] or [step.destination]
    try:
        files = stored_rows(spark, by_arrival(contract), paths)
    except Exception as clash:
        if "MERGE_SCHEMA" not in str(clash):
            raise
        raise QualityError(f"type: files of {step.destination} disagree: {clash}") from clash
    counted = count_folders(files, column, step.partitions).filter(F.col(ARRIVAL).isin(names))
    # What is kept has its shuffle's partitions, few rows each, which adaptive execution does not merge.
    counted = counted.coalesce(spark.sparkContext.defaultParallelism).persist()
    try:
        yield Staged(counted, files.schema)
    finally:
        counted.unpersist()


def record_arrivals(spark: SparkSession, contract: Contract, staged: Staged, arrival: str | None = None) -> None:
    """Put what staging holds of an arrival, or of all, into the manifest."""
    try:
        manifest_of(spark, contract).record(staged.counted, staged.stored, arrival)
    except SchemaDrift as drift:
        raise QualityError(f"type: arrivals of {contract.transform.destination} disagree: {drift}") from drift


def scan_arrivals(spark: SparkSession, contract: Contract, names: list[str] | None = None, text_partitions: bool = False) -> DataFrame:
    """The staging zone that runs have written, without the arrival; with ``names``, only theirs.

    Columns of the whole zone and folders of an arrival come from the manifest; where it
    does not know them, files are listed and their footers merged.
    """
    step, manifest = by_arrival(contract), manifest_of(spark, contract)
    if names is None:
        known = manifest.columns()
        schema = staging_schema(known, step, text_partitions) if known else None
        return scan_staging(spark, step, schema, text_partitions).drop(ARRIVAL)
    entries = [manifest.entries(name) for name in names] if len(names) == 1 else []
    if entries and all(entries):
        folders = [e.folder for one in entries for e in one]
        return scan_staging(spark, step, text_partitions=text_partitions, folders=folders).drop(ARRIVAL)
    rows = scan_staging(spark, step, text_partitions=text_partitions)
    return rows.filter(F.col(ARRIVAL).isin(names)).drop(ARRIVAL)


def stage_dataset(
    raw: DataFrame, contract: Contract, strict: bool = False, pepper: str | None = None
) -> None:
    """Transform the raw rows and write them to the staging zone, which they replace."""
    step = contract.transform
    finest = step.partitions[-1] if step.partitions else None
    stage(
        transform(raw, contract, strict, pepper, spread_by=finest),
        step.destination,
        step.partitions,
        rebalance=False,
        file_format=step.destination_format,
    )


def check_raw(
    spark: SparkSession, raw: DataFrame, contract: Contract, names: list[str], tagged: DataFrame
) -> list[Row]:
    """Gate before the transform: columns, every arrival's rows, casts and keys."""
    missing = validate_columns(raw, contract)
    if missing:
        raise QualityError(f"columns missing from the data: {missing}")
    verdicts = validate_raw(raw, contract, count_rows=True)
    if len(names) > 1:
        arrivals = spark.createDataFrame([(n,) for n in names], f"{ARRIVAL} string")
        verdicts = verdicts.unionByName(validate_arrivals(raw, arrivals, tagged))
    return raise_on_failure(verdicts, REPORT_ONLY)


def check_staging(
    spark: SparkSession, column: str, contract: Contract, names: list[str], before: list[Row], staged: Staged | None = None
) -> list[Row]:
    """Gate after the transform: reads back what was written, with the types in its files.

    Types are those that all files' footers agree on; partition values are read as text
    and tried against the contract's type.  ``column`` is the first of the raw zone,
    ``before`` what the gate there has counted, and ``staged`` what has been read back already.
    """
    if staged is None:
        with read_back(spark, column, contract, names) as staged:
            return check_staging(spark, column, contract, names, before, staged)
    counts = {r["check"]: r["actual"] for r in before if r["subject"] == contract.dataset}
    step = contract.transform
    texts = {p: f"_text_{p}" for p in step.partitions if p in step.casts}
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in staged.stored.fields if f.name in step.casts]
    parts = [
        cast_to(F.col(p), step.casts[p], T.StringType()).alias(p) if p in texts else F.col(p) for p in step.partitions
    ]
    typed = staged.counted.select("n_rows", "n_values", *columns, *parts, *[F.col(p).alias(t) for p, t in texts.items()])
    verdicts = validate_staging(
        typed, contract, column, int(counts["availability"]), int(counts["rows"]), texts, counted=True
    )
    return raise_on_failure(verdicts, REPORT_ONLY)
