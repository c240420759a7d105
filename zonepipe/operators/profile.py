"""Column profiles that merge: one row per arrival and column, brought together without data.

A profile holds exact counts, the least and the most value, a HyperLogLog sketch of distinct
values and, for numbers, a KLL sketch of quantiles.  All of them merge, so the profile of a
zone, of a month or of any other set of arrivals follows from a few rows of each, and only a
new arrival is ever read: one aggregate over it, with partials on the map side.  Sketches are
of bounded size, some 4 kB a column for distinct values and as much for quantiles, whatever
the arrival holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepipe.sources.manifest import ARRIVAL

#: Base-2 logarithm of a distinct sketch's registers: a standard error of 1.04 / 2^6, 1.6 %.
LG_REGISTERS = 12
#: Size of a quantile sketch: a rank is off by 1.33 % at most, with 99 % confidence for one rank.
KLL_SIZE = 200
#: Six standard errors of a distinct count, and three times the stated error of a rank.
DISTINCT_ERROR = 6 * 1.04 / 2 ** (LG_REGISTERS / 2)
RANK_ERROR = 0.04
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def profile(rows: DataFrame) -> DataFrame:
    """One row per column of text, whole numbers or fractions; others are counted only.

    ``least`` and ``most`` are numbers as doubles and NULL for text; NaN is not a value
    that has a rank, and is left out of them and of the quantiles.  A table without rows has
    profiles of zero rows.
    """
    return rows.agg(F.array(*[_column(f) for f in rows.schema.fields]).alias("profiles")).select(F.inline("profiles"))


def _column(field: T.StructField) -> Column:
    value, kind = F.col(f"`{field.name}`"), field.dataType
    nothing, number = F.lit(None), F.lit(None).cast("double")
    if isinstance(kind, T.NumericType):
        number = value.cast("double")
        number = F.when(~F.isnan(number), number)
    atomic = isinstance(kind, (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType))
    # Text stands for a value of any type, so that sketches of arrivals merge where types grew wider.
    text = number.cast("string") if isinstance(kind, T.NumericType) else value.cast("string")
    ranked = isinstance(kind, T.NumericType)
    return F.struct(
        F.lit(field.name).alias("column"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count(value).alias("n_values"),
        F.min(number).alias("least"),
        F.max(number).alias("most"),
        (F.hll_sketch_agg(text, LG_REGISTERS) if atomic else nothing.cast("binary")).alias("distinct_sketch"),
        (F.kll_sketch_agg_double(number, KLL_SIZE) if ranked else nothing.cast("binary")).alias("rank_sketch"),
    )


def merge(profiles: DataFrame) -> DataFrame:
    """Profiles of several arrivals as one, a row per column; an arrival without a column has no part in it."""
    return profiles.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_values").alias("n_values"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.when(F.count("distinct_sketch") > 0, F.hll_union_agg("distinct_sketch")).alias("distinct_sketch"),
        F.kll_merge_agg_double("rank_sketch", KLL_SIZE).alias("rank_sketch"),
    )


def summary(profiles: DataFrame) -> DataFrame:
    """Estimates in place of sketches: ``n_distinct`` and ``quantiles`` at ``QUANTILES``, NULL where there is no number."""
    asked = F.array(*[F.lit(q) for q in QUANTILES])
    known = F.kll_sketch_get_n_double("rank_sketch") > 0
    return profiles.select(
        "column",
        "n_rows",
        "n_values",
        "least",
        "most",
        F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"),
        F.when(known, F.kll_sketch_get_quantile_double("rank_sketch", asked)).alias("quantiles"),
    )


def store_profile(rows: DataFrame, path: str, arrival: str) -> None:
    """Write the profile of one arrival, replacing the one it had."""
    own = profile(rows).withColumn(ARRIVAL, F.lit(arrival)).coalesce(1)
    own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(ARRIVAL).parquet(path)


def stored_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Profiles of all arrivals, with the arrival of each; filters on it list its folder only."""
    kinds = "column string, n_rows long, n_values long, least double, most double, distinct_sketch binary, rank_sketch binary"
    return spark.read.schema(f"{kinds}, {ARRIVAL} string").parquet(path)


def held_against(summed: DataFrame, rows: DataFrame) -> DataFrame:
    """Exact numbers of ``rows`` per column, and whether the estimates are within the stated error.

    ``distinct_ok``: the estimate is within ``DISTINCT_ERROR`` of the exact number.  ``ranks_ok``:
    each quantile's share of values below it, and up to it, encloses the share that was asked
    for, but for ``RANK_ERROR``; NULL for text.  For tests and audits: it reads all rows twice.
    """
    exact = rows.agg(F.array(*[_exact(f) for f in rows.schema.fields]).alias("x")).select(F.inline("x"))
    # One row per column of the table, each with its few quantiles.
    found = {r["column"]: r["quantiles"] for r in summed.select("column", "quantiles").collect()}
    shares = [_shares(f, found.get(f.name)) for f in rows.schema.fields]
    ranks = rows.agg(F.array(*shares).alias("x")).select(F.inline("x"))
    off = F.abs(F.col("n_distinct") - F.col("exact")) <= F.col("exact") * DISTINCT_ERROR
    return (
        summed.join(exact, "column")
        .join(ranks, "column")
        .select("column", "n_rows", "n_values", "least", "most", off.alias("distinct_ok"), "ranks_ok")
    )


def _exact(field: T.StructField) -> Column:
    return F.struct(F.lit(field.name).alias("column"), F.count_distinct(F.col(f"`{field.name}`")).alias("exact"))


def _shares(field: T.StructField, quantiles: list[float] | None) -> Column:
    ok = F.lit(None).cast("boolean")
    if quantiles is not None:
        value = F.col(f"`{field.name}`").cast("double")
        value = F.when(~F.isnan(value), value)
        n, ok = F.count(value), F.lit(True)
        for share, at in zip(QUANTILES, quantiles):
            ok = ok & (F.count_if(value < at) <= (share + RANK_ERROR) * n) & (F.count_if(value <= at) >= (share - RANK_ERROR) * n)
    return F.struct(F.lit(field.name).alias("column"), ok.alias("ranks_ok"))
