"""Landing → raw copy of whole files, byte by byte, checked by digests.

Spark reads landed files as binary rows and deals them over tasks, which write them to the
raw zone; each file appears under its name once it is complete, so a task may be repeated.
Afterwards both zones are read anew and compared by length and SHA-256, which the tasks
that wrote have no part in.  A file has to fit into one binary row (2 GB) and a task.
"""

from __future__ import annotations

import posixpath
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepipe.contract import Contract
from zonepipe.operators.quality import raise_on_failure
from zonepipe.sources.files import files_below, remove
from zonepipe.sources.manifest import plain_path
from zonepipe.sources.zones import arrival_name, arrivals_in

CHECK = "bytes"


def store_of(zone: str) -> tuple[fs.FileSystem, str]:
    """The file system that a zone's path names, and the path in it."""
    if not re.match(r"\w+:", zone):
        return fs.LocalFileSystem(), zone
    uri = re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "file:///", zone))
    return fs.FileSystem.from_uri(uri)


def binary_files(spark: SparkSession, path: str, file_format: str) -> DataFrame:
    """``file, length, content`` of the data files below an arrival's folder, or of one file."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    found = reader.option("pathGlobFilter", f"*.{file_format}").load(path)
    name = plain_path(F.col("path"))
    base = path.rstrip("/").rsplit("/", 1)[-1]
    # Below the arrival, names keep the folders they are in; a file that is the arrival has none.
    inner = F.substring_index(name, f"/{base}/", -1)
    file = F.when(F.endswith(name, F.lit(f"/{base}")), F.lit(base)).otherwise(inner)
    return found.select(file.alias("file"), "length", "content")


def _writer(target: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(target)
        for batch in batches:
            names = batch.column("file").to_pylist()
            for name, content in zip(names, batch.column("content")):
                path = posixpath.join(root, name)
                folder, leaf = posixpath.split(path)
                store.create_dir(folder, recursive=True)
                # Hidden from readers until it is whole.
                part = posixpath.join(folder, f"._{leaf}.{uuid.uuid4().hex}")
                with store.open_output_stream(part, compression=None) as out:
                    out.write(content.as_buffer())
                store.move(part, path)
            yield pa.RecordBatch.from_arrays([batch.column("file")], ["file"])

    return write


def copy_files(spark: SparkSession, source: str, target: str, file_format: str = "parquet") -> int:
    """Copy the data files of one arrival as they are; files that ``target`` holds beside them go. Their number."""
    landed = binary_files(spark, source, file_format)
    # As many rows as files, names only.
    names = {r["file"] for r in landed.mapInArrow(_writer(target), "file string").collect()}
    for file in files_below(spark, target):
        if file.endswith(f".{file_format}") and file not in names:
            remove(spark, f"{target}/{file}")
    return len(names)


def validate_bytes(spark: SparkSession, arrival: str, source: str, target: str, file_format: str = "parquet") -> DataFrame:
    """One verdict: both folders hold the same files with the same bytes, and at least one.

    Each side is one aggregate: its files, its bytes, and the exclusive or of hashes of
    name, length and SHA-256.
    """
    digest = F.xxhash64("file", "length", F.sha2("content", 256))
    files = binary_files(spark, source, file_format).withColumn("side", F.lit("expected"))
    files = files.unionByName(binary_files(spark, target, file_format).withColumn("side", F.lit("actual")))

    def told(side: str):
        of = F.col("side") == side
        parts = (F.count_if(of), F.coalesce(F.sum(F.when(of, F.col("length"))), F.lit(0)), F.coalesce(F.bit_xor(F.when(of, digest)), F.lit(0)))
        return F.concat_ws(":", *[p.cast("string") for p in parts]).alias(side)

    return files.agg(told("expected"), told("actual")).select(
        F.lit(CHECK).alias("check"),
        F.lit(arrival).alias("subject"),
        "expected",
        "actual",
        ((F.col("expected") == F.col("actual")) & ~F.startswith(F.col("expected"), F.lit("0:"))).alias("passed"),
    )


def ingest_bytes(spark: SparkSession, contract: Contract, arrival: str | None = None) -> list[str]:
    """Copy landed arrivals, or one of them, to the raw zone byte by byte; the arrivals copied.

    Raises ``QualityError`` where a copy differs from what has landed, or nothing has.
    """
    step = contract.ingest
    if step.source_format != step.destination_format:
        raise ValueError(f"{contract.dataset} changes its format on the way to the raw zone: its bytes cannot stay")
    landed = [f"{step.source}/{arrival}"] if arrival else arrivals_in(spark, step.source)
    pairs = [(arrival_name(p), p, f"{step.destination}/{arrival_name(p)}") for p in landed]
    for name, source, target in pairs:
        copy_files(spark, source, target, step.source_format)
        raise_on_failure(validate_bytes(spark, name, source, target, step.source_format))
    return [name for name, _, _ in pairs]
