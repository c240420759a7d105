"""Helpers shared by the operators: tables, intermediate results, text expressions."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space class of the contracts, and the words it separates.
WHITESPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

# A side of a join is broadcast only when a count has shown at most so many narrow rows.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where none is set.

    The fallback serves tests in one process.  On a cluster ``spark.checkpoint.dir``
    has to be set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _own_folder()
    return folder.rstrip("/")


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="zonepipe-llm-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends here, lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_checked(left: DataFrame, right: DataFrame, on, how: str, rows: int | None = None) -> DataFrame:
    """Join that broadcasts ``right`` when it is known to have few rows; any other size is shuffled.

    ``rows`` is the counted size of ``right``; it is counted here when not given.
    """
    if (right.count() if rows is None else rows) <= BROADCAST_ROWS:
        right = F.broadcast(right)
    return left.join(right, on, how)


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: str | Column) -> Column:
    """Number of words; 0 for null."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found
