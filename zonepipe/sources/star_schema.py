"""``actives`` and ``viewership`` rows over a star schema of events, customers and parts.

``event_id`` is kept next to the datasets' own columns as a total order.  Joins
are left-deep so that Spark can broadcast each dimension it knows to be small and
shuffle those it does not; adaptive execution splits a hot customer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from a footer once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def actives(spark: SparkSession, sf_dir: str) -> DataFrame:
    phase = F.floor(F.day("ts") / 10).cast("bigint")
    return _placed_events(spark, sf_dir).select(
        _advertising_id(),
        F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("location_category"),
        F.col("r_name").alias("location_granularities"),
        F.array("event_type", F.lit("gps")).alias("location_source"),
        F.col("n_name").alias("state"),
        _epoch().alias("timestamp"),
        F.concat(F.lit("u-"), (F.col("user_id") * 7 + phase).cast("string")).alias("user_id"),
        _latitude().alias("user_latitude"),
        _longitude().alias("user_longitude"),
        *_days(),
        "event_id",
    )


def viewership(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    n_parts = part.agg(F.count(F.lit(1))).scalar()
    shows = part.select("p_partkey", "p_type", "p_brand")
    events = _placed_events(spark, sf_dir).withColumn("part", F.col("event_id") % n_parts)
    return events.join(shows, F.col("part") == F.col("p_partkey")).select(
        _advertising_id(),
        F.col("p_type").alias("channel_genre"),
        F.col("p_brand").alias("channel_name"),
        F.col("n_name").alias("city"),
        F.col("event_type").alias("device"),
        F.col("event_type").alias("device_type"),
        F.floor("value").cast("bigint").alias("duration"),
        (F.lit(1000) + F.col("event_id") % 1001).cast("string").alias("grid_id"),
        F.col("r_name").alias("language"),
        F.col("c_mktsegment").alias("location_category"),
        F.col("r_name").alias("location_granularities"),
        F.array("event_type", F.lit("gps")).alias("location_source"),
        _epoch().alias("record_timestamp"),
        F.when(F.col("event_id") % 2 == 0, "Y").otherwise("N").alias("show_genre"),
        F.when(F.col("event_id") % 3 == 0, "Y").otherwise("N").alias("show_name"),
        F.col("n_name").alias("state"),
        _latitude().alias("user_lat"),
        _longitude().alias("user_long"),
        *_days(),
        "event_id",
    )


def _placed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, customer, nation, region = (
        table(spark, sf_dir, t) for t in ("events", "customer", "nation", "region")
    )
    return (
        events.join(customer, F.col("user_id") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )


def _advertising_id() -> Column:
    return F.md5(F.concat(F.lit("ad-"), F.col("user_id").cast("string"))).alias("advertising_id")


def _epoch() -> Column:
    # Event times carry no zone; built from their fields it does not depend on the session's.
    clock = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    return F.unix_date(F.to_date("ts")).cast("bigint") * 86400 + clock


def _latitude() -> Column:
    return (F.col("event_id") * 7919 % 18000).cast("double") / 100.0 - 90.0


def _longitude() -> Column:
    return (F.col("event_id") * 104729 % 36000).cast("double") / 100.0 - 180.0


def _days() -> list[Column]:
    # Casts, as patterns format each row at several times the cost.
    month = F.lpad(F.month("ts").cast("string"), 2, "0")
    return [month.alias("month"), F.to_date("ts").cast("string").alias("date")]
