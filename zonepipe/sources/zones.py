"""Zone scans and sinks: landing → raw copy, partitioned and flat staging."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepipe.contract import Contract, ZoneStep
from zonepipe.functions import FLATTEN, flatten_to_string, parse_type
from zonepipe.operators.quality import count_by_file
from zonepipe.operators.transform import spread
from zonepipe.sources.files import glob, literal
from zonepipe.sources.manifest import ARRIVAL

# Fixed value: index column that pandas may add to the files it writes.
PANDAS_INDEX = "__index_level_0__"
UNROUTED = "unrouted"
#: Arrivals whose footers are read at a time, where a zone's do not merge.
FOOTER_JOBS = 16
#: The most tasks that Spark deals a listing of many folders to, up to which each folder is a task.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: Tasks of such a listing for each core.
LISTINGS_A_CORE = 4


class SchemaClash(Exception):
    """Arrivals of one zone hold a column in types that do not fit together."""


def scan_zone(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    file_format: str = "parquet",
    step: ZoneStep | None = None,
) -> DataFrame:
    """All data files below an unpartitioned zone (landing, raw), one folder or file per arrival.

    No column of any arrival is lost: the footers of all files are merged.  With ``step``,
    columns it renames are brought to their new name, whichever name an arrival uses, and
    arrivals that hold a column as text and as an array, which the contract flattens, or as
    numbers of different types are brought together: one scan for each shape, however many
    arrivals have it.  Other clashes raise ``SchemaClash``.
    Files that are not of the zone's format are passed over.
    """
    paths = [path] if isinstance(path, str) else list(path)

    def load(folders: Sequence[str], known: T.StructType | None) -> DataFrame:
        reader = spark.read.format(file_format).option("recursiveFileLookup", "true")
        reader = reader.option("pathGlobFilter", f"*.{file_format}")
        reader = reader.schema(known) if known is not None else reader.option("mergeSchema", "true")
        return reader.load(list(folders)).drop(PANDAS_INDEX)

    try:
        rows = load(paths, schema)
    except Exception as clash:
        if "MERGE_SCHEMA" not in str(clash) or schema is not None:
            raise
        arrivals = [a for p in paths for a in [literal(a) for a in arrivals_in(spark, p)] or [p]]
        with ThreadPoolExecutor(FOOTER_JOBS) as pool:
            shapes = list(pool.map(lambda a: load([a], None).schema, arrivals))
        groups: dict[str, list[int]] = {}
        for number, shape in enumerate(shapes):
            groups.setdefault(shape.json(), []).append(number)
        rows = _fitted([load([arrivals[n] for n in g], shapes[g[0]]) for g in groups.values()], step)
    return one_name(rows, step.rename) if step else rows


def arrivals_in(spark: SparkSession, zone: str) -> list[str]:
    """Paths of a zone's arrivals, each a folder or a file; markers and hidden files are none."""
    return [p for p in glob(spark, f"{zone}/*") if not p.rsplit("/", 1)[1].startswith(("_", "."))]


def one_name(rows: DataFrame, rename: Mapping[str, str]) -> DataFrame:
    """Renamed columns under their new name; a row has it from whichever name its arrival used."""
    for old, new in rename.items():
        if old in rows.columns and new in rows.columns:
            rows = rows.withColumn(new, F.coalesce(new, old)).drop(old)
        else:
            rows = rows.withColumnRenamed(old, new)
    return rows


def _fitted(parts: list[DataFrame], step: ZoneStep | None) -> DataFrame:
    """Scans of different types under one another."""
    types: dict[str, list[T.DataType]] = {}
    for part in parts:
        for f in part.schema.fields:
            if f.dataType not in types.setdefault(f.name, []):
                types[f.name].append(f.dataType)
    flat = {c for c, spec in (step.casts if step else {}).items() if spec.strip() == FLATTEN}
    targets: dict[str, T.DataType] = {}
    for name, kinds in types.items():
        if len(kinds) == 1:
            continue
        if name in flat and all(isinstance(k, (T.StringType, T.ArrayType)) for k in kinds):
            targets[name] = T.StringType()
        elif all(isinstance(k, T.IntegralType) for k in kinds):
            targets[name] = T.LongType()
        elif all(isinstance(k, T.NumericType) and not isinstance(k, T.DecimalType) for k in kinds):
            targets[name] = T.DoubleType()
        else:
            raise SchemaClash(f"column {name} arrives as {', '.join(sorted(k.simpleString() for k in kinds))}")

    def fit(part: DataFrame) -> DataFrame:
        own = {n: t for n, t in targets.items() if n in part.columns}
        return part.withColumns(
            {
                n: flatten_to_string(F.col(n), part.schema[n].dataType) if n in flat else F.col(n).cast(t)
                for n, t in own.items()
            }
        )

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(fit, parts))


def scan_staging(
    spark: SparkSession,
    step: ZoneStep,
    schema: T.StructType | None = None,
    text_partitions: bool = False,
    folders: Sequence[str] | None = None,
) -> DataFrame:
    """A staging zone, with partition values in their written types.

    ``text_partitions`` reads every partition value as text, whatever the contract says.
    Jobs know the schema and pass it.  Without one, the data columns come from the
    files' footers and partition columns are text unless the contract casts them,
    so month ``01`` stays ``01``.  With ``folders``, relative to the zone, nothing else
    is listed or opened.
    """
    paths = [step.destination] if folders is None else [f"{step.destination}/{f}" for f in folders]
    if schema is None and step.partitions:
        schema = staging_schema(stored_columns(spark, step, paths), step, text_partitions)
    reader = spark.read.format(step.destination_format)
    if folders is not None:
        reader = reader.option("basePath", step.destination)
    if schema is not None:
        reader = reader.schema(schema)
    with long_listing(spark):
        return reader.load(paths)


def stored_columns(spark: SparkSession, step: ZoneStep, paths: Sequence[str]) -> T.StructType:
    """The columns that the files below ``paths`` hold, all footers merged."""
    return stored_rows(spark, step, paths).schema


def stored_rows(spark: SparkSession, step: ZoneStep, paths: Sequence[str]) -> DataFrame:
    """The files below ``paths`` without partition columns, all footers merged; one listing."""
    reader = spark.read.format(step.destination_format).option("recursiveFileLookup", "true").option("mergeSchema", "true")
    with long_listing(spark):
        return reader.load(list(paths)).drop(*step.partitions)


@contextmanager
def long_listing(spark: SparkSession) -> Iterator[None]:
    """Scans made here list their folders in a few tasks a core, each of them many folders.

    Left to itself Spark makes a task of each folder, which takes far longer than to list it.
    """
    before = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(min(int(before), LISTINGS_A_CORE * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, before)


def staging_schema(stored: T.StructType, step: ZoneStep, text_partitions: bool = False) -> T.StructType:
    """Stored columns and after them the partition columns, typed by the contract or text."""
    parts = [
        T.StructField(p, parse_type(step.casts[p]) if p in step.casts and not text_partitions else T.StringType())
        for p in step.partitions
    ]
    return T.StructType([*stored.fields, *parts])


def stage(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = (),
    rebalance: bool = True,
    overwrite: str = "static",
    max_records_per_file: int | None = None,
    file_format: str = "parquet",
) -> None:
    """Write a zone, replacing it.

    With partition columns the rows are rebalanced by the last (finest) one,
    unless the caller has done so: small partitions end up in few files, and
    adaptive execution splits a hot partition over many tasks.
    ``overwrite="dynamic"`` replaces only the partitions present in ``df``.
    """
    if partitions and rebalance:
        df = spread(df, partitions[-1])
    writer = df.write.format(file_format).mode("overwrite")
    writer = writer.option("partitionOverwriteMode", overwrite)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.save(path)


def ingest_raw(spark: SparkSession, contract: Contract, arrival: str | None = None) -> list[str]:
    """Copy landed rows to the raw zone without changing them; the arrivals copied.

    Each arrival goes to its own folder of the raw zone, with the columns and types it came
    with; repeating it replaces that folder and nothing else.  Without ``arrival``, all
    landed ones are copied in turn; earlier ones that landing no longer holds stay.
    """
    step = contract.ingest
    landed = [f"{step.source}/{arrival}"] if arrival else arrivals_in(spark, step.source)
    names = []
    for source in landed:
        name = arrival_name(source)
        rows = scan_zone(spark, source, file_format=step.source_format)
        stage(rows, f"{step.destination}/{name}", file_format=step.destination_format)
        names.append(name)
    return names


def arrival_name(path: str) -> str:
    """The stem of a landed object."""
    return path.rstrip("/").rsplit("/", 1)[-1].split(".")[0]


def land(df: DataFrame, contract: Contract, stamp: str) -> str:
    """Put ``df`` into the landing zone as the arrival ``<dataset>_<stamp>``."""
    arrival = f"{contract.dataset}_{stamp}"
    stage(df, f"{contract.ingest.source}/{arrival}", file_format=contract.ingest.source_format)
    return arrival


def route(path: Column, datasets: Iterable[str]) -> tuple[Column, Column]:
    """Arrival and dataset of a landed file's path.

    The arrival is the stem of the landed object: the file itself, or the folder
    around Spark part files.  ``<dataset>`` and ``<dataset>_<anything>`` belong to
    a dataset; whatever matches none is labelled ``unrouted`` and kept.
    """
    steps = F.split(path, "/")
    file = F.element_at(steps, -1)
    landed = F.when(file.startswith("part-"), F.element_at(steps, -2)).otherwise(file)
    arrival = F.split_part(landed, F.lit("."), F.lit(1))
    dataset = F.lit(UNROUTED)
    for name in sorted(datasets, key=len):  # the longest matching name decides
        dataset = F.when((arrival == name) | arrival.startswith(f"{name}_"), name).otherwise(dataset)
    return arrival.alias("arrival"), dataset.alias("dataset")


def with_route(df: DataFrame, datasets: Iterable[str]) -> DataFrame:
    """Add ``arrival`` and ``dataset`` to a file-backed (batch or streaming) frame."""
    return df.select("*", *route(F.col("_metadata.file_path"), datasets))


def route_files(spark: SparkSession, root: str, datasets: Iterable[str]) -> DataFrame:
    """Landed arrivals below ``root``: dataset, arrival and rows.

    Reads no data column, so arrivals of different shape can lie side by side
    and row counts come from file footers.  Rows are counted per file before
    anything looks at a path.
    """
    files = count_by_file(scan_zone(spark, root))
    arrival, dataset = route(F.col("file_path"), datasets)
    return (
        files.select(arrival, dataset, "n_rows")
        .groupBy("dataset", "arrival")
        .agg(F.sum("n_rows").alias("n_rows"))
    )
