"""The corpus pipeline: quality, near copies, benchmark leaks, mix, shards.

``STAGES`` are ``(name, function)`` pairs; each function takes ``(spark, docs, sf_dir)``
and returns a DataFrame that the runner writes as Parquet and reads again as the next
stage's ``docs``.  All but the last return the columns of ``documents``; the last adds the
shard and the slot in it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepipe.llm import decontamination, mixing, quality, sharding, simhash
from zonepipe.llm.common import shared_folder, table, text_or_empty, word_count
from zonepipe.llm.queries import MIX_MOST, MIX_SEED, MIX_SHARE, MIX_WEIGHTS, N_SHARDS, remainder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from labelled ones not held out."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"), learn_from=remainder("doc_id", 3) != 1)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near copies."""
    return simhash.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    # The row travels as one column, so that no column of it can clash with the mix's own.
    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("document"), "doc_id", "source", word_count("text").alias("words")
    )
    mixed = mixing.mix(rows, MIX_WEIGHTS, MIX_SHARE, MIX_MOST, MIX_SEED, size=F.col("words"))
    copies = F.sequence(F.lit(1).cast("long"), F.col("copies"))
    return mixed.where("copies > 0").select("document", F.explode(copies)).select("document.*")


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard of near equal bytes they belong to, and their slot in it."""
    return sharding.shard_by_bytes(docs, N_SHARDS, F.octet_length(text_or_empty("text")) + 8)


STAGES: list[tuple[str, Stage]] = [
    ("quality", accept_quality),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", cut_shards),
]

#: The classifier and the fingerprints are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    folder = f"{shared_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
