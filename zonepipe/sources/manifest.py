"""What every arrival has written to a staging zone: its folders, counts and columns.

``<zone>/_manifest/arrival=A/n=N/part-….parquet``  folders of arrival A
``<zone>/_manifest/columns/n=N/part-….parquet``    the columns of all arrivals together

Each ``n=N`` is one file, complete once it is there, and the highest counts.  Before a run
touches staging it announces all folders that may hold rows of its arrival, those of
earlier tries included; afterwards it records what is there.  A run that dies in between
leaves the announcement, so a repeated run, of the same or of corrected rows, knows what to
remove without listing the zone.  A run reads two small files of the manifest, however many
arrivals the zone holds.

Names below ``_`` are hidden from Spark's scans of the zone, and a run that replaces the
whole zone replaces its manifest too.  One writer at a time.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepipe.sources.files import glob, literal, make_folders, remove

ARRIVAL = "arrival"
#: Stale folders that are removed, or new ones' parents that are made, at a time.
REMOVALS = 16
ENTRY = "folder string, n_rows long, n_values long, schema string"


class SchemaDrift(Exception):
    """Arrivals of one staging zone have written a column in different types."""


@dataclass(frozen=True)
class Entry:
    """One folder of an arrival, relative to the zone; counts are None while it is only announced."""

    folder: str
    n_rows: int | None = None
    n_values: int | None = None
    schema: str | None = None


@cache
def _catalog_names(spark: SparkSession):
    # Every step of a Java name is a call to the JVM.
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils


def escaped(spark: SparkSession, value: str | None) -> str:
    """A partition value as Spark writes it into a folder's name."""
    names = _catalog_names(spark)
    return names.escapePathName(value) if value else names.DEFAULT_PARTITION_NAME()


def plain_path(uri: Column) -> Column:
    """A file's path as folders are named, from the URI that Spark tells."""
    return F.try_url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def folders_of(spark: SparkSession, rows: DataFrame, partitions: Sequence[str], arrival: str) -> list[str]:
    """Folders that ``rows`` of an arrival go to: one aggregate over the partition columns.

    A value's name is asked of Spark once, in however many folders it is.
    """
    named = cache(lambda value: escaped(spark, value))
    last = f"{ARRIVAL}={escaped(spark, arrival)}"
    if not partitions:
        return [last]
    found = rows.select(*[F.col(p).cast("string") for p in partitions]).distinct().collect()
    return sorted("/".join([*[f"{p}={named(r[p])}" for p in partitions], last]) for r in found)


def count_folders(files: DataFrame, column: str, partitions: Sequence[str]) -> DataFrame:
    """Rows, and those with a value in ``column``, of each folder of staged arrivals.

    Beside them are the arrival and the partition values as text, read off the folder's name.
    ``files`` is a scan without partition columns.  Rows are counted per file before anything
    looks at a path.
    """
    n_values = F.count(column) if column in files.columns else F.count(F.lit(1))
    by_file = files.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"), n_values.alias("n_values")
    )
    names = [*partitions, ARRIVAL]
    steps = F.slice(F.split(plain_path(F.col("file")), "/"), -len(names) - 1, len(names))
    found = by_file.select(F.array_join(steps, "/").alias("folder"), "n_rows", "n_values")
    found = found.groupBy("folder").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"))
    texts = {n: _partition_text(F.get(F.split("folder", "/"), F.lit(i))) for i, n in enumerate(names)}
    rows = found.select("*", *[text.alias(n) for n, text in texts.items()])
    if column in texts:
        rows = rows.withColumn("n_values", F.when(F.col(column).isNull(), F.lit(0)).otherwise(F.col("n_rows")))
    return rows


def _partition_text(step: Column) -> Column:
    """The value in a folder's name as Spark reads it."""
    value = F.regexp_replace(step, "^[^=]*=", "")
    return F.when(value != "__HIVE_DEFAULT_PARTITION__", F.coalesce(plain_path(value), value))


class Manifest:
    """The manifest of a staging zone with the arrival as its last partition column."""

    def __init__(self, spark: SparkSession, zone: str, partitions: Sequence[str]):
        self.spark, self.zone, self.partitions = spark, zone.rstrip("/"), list(partitions)

    def entries(self, arrival: str) -> list[Entry]:
        """What is known of an arrival; nothing if it was never announced."""
        rows = self._newest(self._arrival(arrival), ENTRY)
        return sorted((Entry(*r) for r in rows), key=lambda e: e.folder)

    def columns(self) -> T.StructType | None:
        """The data columns of all recorded arrivals, known without opening their files."""
        rows = self._newest("columns", "schema string")
        return T.StructType.fromJson(json.loads(rows[0]["schema"])) if rows else None

    def make_way(self, arrival: str, rows: DataFrame) -> list[str]:
        """Prepare for ``rows`` replacing the arrival; the folders removed, which they do not go to.

        What new folders lie in is made here, many at a time: Spark's committer would make
        each after the other.  May be repeated after any failure.
        """
        new = folders_of(self.spark, rows, self.partitions, arrival)
        old = [e.folder for e in self.entries(arrival)] or self._unannounced(arrival)
        stale = sorted(set(old) - set(new))
        if stale:
            self._announce(arrival, {*old, *new})
            with ThreadPoolExecutor(REMOVALS) as pool:
                list(pool.map(lambda folder: remove(self.spark, f"{self.zone}/{folder}"), stale))
        if stale or set(old) != set(new):
            self._announce(arrival, new)
        around = sorted({folder.rpartition("/")[0] for folder in set(new) - set(old)} - {""})
        make_folders(self.spark, self.zone, around, REMOVALS)
        return stale

    def record(self, counted: DataFrame, stored: T.StructType, arrival: str | None = None) -> None:
        """Keep what is staged by folder; with ``arrival`` only that one was read, else all.

        ``counted`` is from ``count_folders`` and ``stored`` the columns of the files.  Raises
        ``SchemaDrift`` where they do not fit those of earlier arrivals.
        """
        known = self.columns() if arrival is not None else None
        together = merged(known, stored) if known else stored
        counted = counted.select(ARRIVAL, "folder", "n_rows", "n_values", F.lit(stored.json()).alias("schema"))
        if arrival is not None:
            self._add(self._arrival(arrival), counted.drop(ARRIVAL))
        else:
            # All arrivals in one job, one file for each.
            counted.withColumn("n", F.lit(1)).repartition(ARRIVAL).write.partitionBy(ARRIVAL, "n").mode("overwrite").option(
                "partitionOverwriteMode", "static"
            ).parquet(f"{self.zone}/_manifest")
        if together != known:
            self._add("columns", self.spark.range(1).select(F.lit(together.json()).alias("schema")))

    def _arrival(self, arrival: str) -> str:
        return f"{ARRIVAL}={escaped(self.spark, arrival)}"

    def _announce(self, arrival: str, folders: Iterable[str]) -> None:
        # An Arrow table goes to the JVM as it is; a list would wait for Python workers to start.
        known = self.spark.createDataFrame(pa.table({"folder": pa.array(sorted(folders), pa.string())}))
        unknown = [F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(ENTRY).fields[1:]]
        self._add(self._arrival(arrival), known.select("folder", *unknown))

    def _unannounced(self, arrival: str) -> list[str]:
        """Folders of an arrival in a zone that has no manifest yet, by a listing."""
        if glob(self.spark, f"{self.zone}/_manifest"):
            return []
        steps = "/".join([*[f"{p}=*" for p in self.partitions], literal(self._arrival(arrival))])
        return ["/".join(p.rsplit("/", len(self.partitions) + 1)[1:]) for p in glob(self.spark, f"{self.zone}/{steps}")]

    def _files(self, part: str) -> dict[int, list[str]]:
        found: dict[int, list[str]] = {}
        for path in glob(self.spark, f"{self.zone}/_manifest/{literal(part)}/n=*/part-*"):
            found.setdefault(int(re.search(r"/n=(\d+)/[^/]*$", path)[1]), []).append(path)
        return found

    def _newest(self, part: str, schema: str) -> list[T.Row]:
        files = self._files(part)
        return self.spark.read.schema(schema).parquet(*files[max(files)]).collect() if files else []

    def _add(self, part: str, rows: DataFrame) -> None:
        older = self._files(part)
        root = f"{self.zone}/_manifest/{part}"
        rows.coalesce(1).write.mode("overwrite").parquet(f"{root}/n={max(older, default=0) + 1}")
        for n in older:
            remove(self.spark, f"{root}/n={n}")


def merged(a: T.StructType, b: T.StructType) -> T.StructType:
    """Columns of both; one that both have has to be of one type."""
    fields = {f.name: f for f in a.fields}
    for f in b.fields:
        mine = fields.setdefault(f.name, f)
        if mine.dataType.simpleString() != f.dataType.simpleString():
            raise SchemaDrift(f"column {f.name} was staged as {mine.dataType.simpleString()} and as {f.dataType.simpleString()}")
    return T.StructType(list(fields.values()))
