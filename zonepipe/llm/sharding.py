"""Balanced contiguous shards from global byte prefix sums.

Rows are put into id ranges (buckets).  Each bucket's total is known from one
aggregation; the sum of the totals before a bucket plus a running sum inside it is the
global prefix sum of a row, and equal cuts of the grand total are the shard borders.
No step sorts or sums all rows in one task.  An id that fills whole buckets (null, or a
value repeated very often) is spread over sub-buckets by a hash of the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zonepipe.llm.common import unused, written

SUB_BUCKETS = 64
# Accuracy of the border estimate; borders decide the layout of tasks, never a result.
BORDER_ACCURACY = 20_000


def _borders(df: DataFrame, id_col: str, buckets: int) -> list[int]:
    shares = [i / buckets for i in range(1, buckets)]
    row = df.agg(F.percentile_approx(F.col(id_col), F.lit(shares), F.lit(BORDER_ACCURACY)).alias("b")).first()
    return list(row["b"] or [])


def _bucket(value: Column, borders: list[int]) -> Column:
    """Number of borders at or below ``value``, by binary search in an array constant."""
    steps = max(1, len(borders).bit_length())
    padded = F.array(*[F.lit(int(b)).cast("long") for b in borders]) if borders else F.array(F.lit(0).cast("long"))
    jumps = F.array(*[F.lit(1 << s) for s in range(steps - 1, -1, -1)])
    return F.aggregate(
        jumps,
        F.lit(0),
        lambda at, jump: F.when(
            (at + jump <= len(borders)) & (F.get(padded, at + jump - 1) <= value), at + jump
        ).otherwise(at),
    )


def shard_by_bytes(
    df: DataFrame, n_shards: int, size: Column, id_col: str = "doc_id", buckets: int | None = None
) -> DataFrame:
    """All rows of ``df`` plus ``shard`` and ``slot``; shards are contiguous in id order.

    ``size`` is the row's weight, a non-negative long.  A row belongs to the shard in which
    its middle byte falls, so a shard's bytes differ from the target by at most one row's
    size on either side.  ``slot`` counts from 0 inside a shard, in id order.  Null ids come
    first; rows with equal ids are ordered by a hash of all their columns, and rows that are
    equal throughout are interchangeable.  With fewer rows than shards some shards stay
    empty; an empty table gives an empty result.  Columns of ``df`` named ``shard`` or
    ``slot`` are replaced.
    """
    columns = [c for c in df.columns if c not in ("shard", "slot")]
    df = df.select(*columns)
    size_c, tie, bucket, sub, before, row, base, base_row, start = unused(
        df, "size_", "tie_", "bucket_", "sub_", "before_", "row_", "base_", "base_row_", "start_"
    )
    if buckets is None:
        buckets = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    raw = _borders(df, id_col, buckets)
    hot = sorted({a for a, b in zip(raw, raw[1:]) if a == b})
    borders = sorted({*raw, *(h + 1 for h in hot)})

    spread = F.pmod(F.col(tie), F.lit(SUB_BUCKETS)).cast("int")
    is_hot = F.col(id_col).isNull() | (F.col(id_col).isin(hot) if hot else F.lit(False))
    placed = (
        df.withColumn(size_c, F.greatest(F.coalesce(size.cast("long"), F.lit(0).cast("long")), F.lit(0).cast("long")))
        .withColumn(tie, F.xxhash64(*columns))
        .withColumn(bucket, F.when(F.col(id_col).isNull(), -1).otherwise(_bucket(F.col(id_col), borders)))
        .withColumn(sub, F.when(is_hot, spread).otherwise(0))
    )
    narrow = written(placed.select(F.col(id_col).alias("id"), size_c, tie, bucket, sub), "sizes")

    order = Window.orderBy(bucket, sub).rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        narrow.groupBy(bucket, sub)
        .agg(F.sum(size_c).alias("bytes"), F.count("*").alias("rows"))
        .select(
            bucket,
            sub,
            F.coalesce(F.sum("bytes").over(order), F.lit(0)).alias(base),
            F.coalesce(F.sum("rows").over(order), F.lit(0)).alias(base_row),
        )
    )
    total = max(1, narrow.agg(F.sum(size_c)).first()[0] or 0)

    def cut(rows: DataFrame, id_name: str) -> DataFrame:
        inside = Window.partitionBy(bucket, sub).orderBy(F.col(id_name).asc_nulls_first(), tie, size_c)
        # One row per bucket: at most ``buckets`` and SUB_BUCKETS for each hot id.
        return (
            rows.withColumn(row, F.row_number().over(inside))
            .withColumn(before, F.sum(size_c).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col(size_c))
            .join(F.broadcast(bases), [bucket, sub])
            .withColumn(
                "shard",
                F.least(
                    F.lit(n_shards - 1),
                    F.expr(f"((2 * (`{base}` + `{before}`) + `{size_c}`) * {n_shards}L) div {2 * total}L").cast("int"),
                ),
            )
            .withColumn(row, F.col(row) + F.col(base_row) - 1)
        )

    starts = cut(narrow, "id").groupBy("shard").agg(F.min(row).alias(start))
    return (
        cut(placed, id_col)
        .join(F.broadcast(starts), "shard")
        .select(*columns, "shard", (F.col(row) - F.col(start)).cast("long").alias("slot"))
    )
