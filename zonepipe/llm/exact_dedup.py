"""Exact deduplication by progressive refinement.

Texts are equal when they are identical after white space is deleted.  Documents are
grouped by normalised length, groups of two and more by the hash of a prefix, and only
documents in groups that survive both get a hash of their whole text.

Which groups survive is sent to every task as a filter of fixed size, one bit per hash of
a group.  Two groups on one bit cost a hash that was not needed and change no result.

Shuffles carry lengths and hashes, never texts.  Copies are counted with partial
aggregation, so a group that holds a third of all rows reaches each reducer as one row
per task; the join that hands the group's result back is one that adaptive execution
can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepipe.llm.common import WHITESPACE, text_or_empty, unused, written

PREFIX_CHARS = 64
#: Bits of the filter of surviving groups: 8 MB, whatever the size of the corpus.
FILTER_BITS = 1 << 26
# Fixed value: bits of one bitmap that Spark's bitmap aggregate makes.
BITMAP_BITS = 1 << 15


def normalised(text: str | Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(text_or_empty(text), WHITESPACE, "")


def _shared(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key combinations that at least two of the counted rows have."""
    return df.groupBy(*keys).agg(F.sum("rows").alias("rows")).where("rows > 1")


def surviving_prefixes(df: DataFrame, text_col: str = "text", prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """``(length, prefix)`` groups of at least two documents, found length first."""
    norm = normalised(text_col)
    sized = written(
        df.select(F.length(norm).alias("length"), F.xxhash64(F.substring(norm, 1, prefix_chars)).alias("prefix"))
        .groupBy("length", "prefix")
        .agg(F.count("*").alias("rows")),
        "lengths",
    )
    lengths = _shared(sized, ["length"]).select("length")
    return _shared(sized.join(lengths, "length", "left_semi"), ["length", "prefix"]).select("length", "prefix")


def _bit(length: str, prefix: str) -> Column:
    return F.pmod(F.xxhash64(length, prefix), F.lit(FILTER_BITS))


def survivor_filter(survivors: DataFrame) -> DataFrame:
    """``map, bits``: bitmaps with a bit for each ``(length, prefix)``, at most FILTER_BITS in all."""
    return (
        survivors.select(_bit("length", "prefix").alias("bit"))
        .select(F.expr(f"bit div {BITMAP_BITS}").alias("map"), F.pmod("bit", F.lit(BITMAP_BITS)).alias("at"))
        .groupBy("map")
        .agg(F.bitmap_construct_agg("at").alias("bits"))
    )


def _is_set(bits: Column, bit: Column) -> Column:
    at = F.pmod(bit, F.lit(BITMAP_BITS)).cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("long"), at % 8) == 1


def exact_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS
) -> DataFrame:
    """All rows of ``df`` without the text, plus ``keep_id``, ``group_size`` and ``kept``.

    Of equal texts the row with the most code points in the original text stays, then the
    smallest id; a null id ranks last, and of rows that repeat an id and text exactly one
    is kept.  Null and empty texts equal each other and texts of white space alone.
    An empty table gives an empty result.  A column of ``df`` named like a result column
    is replaced.
    """
    results = (text_col, "keep_id", "group_size", "kept")
    carried = [c for c in df.columns if c not in results]
    points, uid, length, prefix, body, bit, slot, bits, digest, best, keep_row = unused(
        df, "points_", "uid_", "length_", "prefix_", "body_", "bit_", "map_", "bits_", "digest_", "best_", "keep_row_"
    )
    norm = normalised(text_col)
    survivors = written(survivor_filter(surviving_prefixes(df, text_col, prefix_chars)), "survivors").toDF(slot, bits)

    seen = df.select(
        *carried,
        F.length(text_or_empty(text_col)).alias(points),
        F.length(norm).alias(length),
        F.xxhash64(F.substring(norm, 1, prefix_chars)).alias(prefix),
        norm.alias(body),
        F.monotonically_increasing_id().alias(uid),
    )
    full = F.sha2(F.col(body), 256)
    marked = (
        seen.withColumn(bit, _bit(length, prefix))
        .join(F.broadcast(survivors), F.expr(f"`{bit}` div {BITMAP_BITS}") == F.col(slot), "left")
        .withColumn(digest, F.when(_is_set(F.col(bits), F.col(bit)), full))
    )
    hashed = written(marked.select(*carried, points, length, uid, digest), "hashed")

    rank = F.struct(
        F.col(points), (-F.col(id_col)).alias("small_id"), (-F.col(uid)).alias("early"), F.col(id_col).alias("id")
    )
    groups = (
        hashed.where(F.col(digest).isNotNull())
        .groupBy(digest, length)
        .agg(F.count("*").alias("group_size"), F.max(rank).alias(best))
        .select(
            digest,
            F.col(best)["id"].alias("keep_id"),
            "group_size",
            (-F.col(best)["early"]).alias(keep_row),
        )
    )
    copies = hashed.where(F.col(digest).isNotNull()).join(groups, digest)
    single = hashed.where(F.col(digest).isNull())
    return copies.select(
        *carried, "keep_id", "group_size", (F.col(uid) == F.col(keep_row)).alias("kept")
    ).unionByName(
        single.select(
            *carried,
            F.col(id_col).alias("keep_id"),
            F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept"),
        )
    )
