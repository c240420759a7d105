"""File-system calls on the driver: listings, markers, folders and removals, never data."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths that match ``pattern``, sorted; one listing."""
    files, where = _at(spark, pattern)
    return sorted(str(s.getPath()) for s in files.globStatus(where) or [])


def files_below(spark: SparkSession, path: str) -> list[str]:
    """All files below a folder, relative to it; none if there is no folder."""
    files, where = _at(spark, path)
    if not files.exists(where):
        return []
    root, found, names = files.getFileStatus(where).getPath().toUri().getPath(), files.listFiles(where, True), []
    while found.hasNext():
        names.append(found.next().getPath().toUri().getPath()[len(root.rstrip("/")) + 1 :])
    return sorted(names)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file at ``path``."""
    files, where = _at(spark, path)
    files.create(where, True).close()


def make_folders(spark: SparkSession, zone: str, folders: Sequence[str], at_a_time: int) -> None:
    """``folders`` of a zone, with those above them; one that is there is left as it is."""
    # Names of Java classes are resolved once: every step of one is a call to the JVM.
    files, _ = _at(spark, zone)
    path = spark._jvm.org.apache.hadoop.fs.Path
    with ThreadPoolExecutor(at_a_time) as pool:
        list(pool.map(lambda folder: files.mkdirs(path(f"{zone}/{folder}")), folders))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder; a missing one is no error."""
    files, where = _at(spark, path)
    files.delete(where, True)


def literal(name: str) -> str:
    """A name or path inside a glob pattern, or where Spark reads a path as one."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", name)
