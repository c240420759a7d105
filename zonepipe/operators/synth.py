"""Synthetic ``actives`` and ``viewership`` rows, derived from a row id and a seed.

Each row's values are slices of SHA-256 digests of ``seed-id``, so a row depends
on nothing but its id: any number of rows, in any partitioning, on any cluster,
gives the same data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Small vocabularies the text columns are picked from, one for each kind of column.
CITIES = ("Ashford", "Brookside", "Clearwater", "Dunmore", "Eastvale", "Fairview", "Glenrock", "Harwick")
REGIONS = ("North", "South", "East", "West", "Central", "Coastal")
PLACES = ("home", "office", "transit", "shop", "park", "school", "stadium")
GRAINS = ("point", "street", "district", "postcode", "city")
ORIGINS = ("gps", "wifi", "cell", "ip")
CHANNELS = ("Kite TV", "Meadow News", "Harbor Sports", "Lantern Kids", "Orbit Science", "Drift Music")
GENRES = ("news", "sport", "drama", "comedy", "documentary", "music", "kids")
LANGUAGES = ("de", "en", "es", "fr", "hi", "ja", "pt", "sw")
DEVICES = ("tv-basic", "tv-pro", "box-one", "box-two", "stick", "tablet-mini")
DEVICE_TYPES = ("television", "set-top box", "stick", "tablet", "phone")
FLAGS = ("Y", "N")

SLOT = 7  # hex digits per slice: 28 bits, far above every modulus used here
BLOCK = 64 // SLOT  # slices per digest
FIRST_DAY, DAYS = "2020-01-01", 366


def synth_actives(ids: DataFrame, id_column: str, seed: int = 0) -> DataFrame:
    """One ``actives`` row per id."""
    make = _Row(id_column, seed, slots=10)
    return make.over(ids).select(
        make.advertising_id(),
        make.pick(0, CITIES).alias("city"),
        make.pick(1, PLACES).alias("location_category"),
        make.pick(2, GRAINS).alias("location_granularities"),
        make.pick(3, ORIGINS).alias("location_source"),
        make.pick(4, REGIONS).alias("state"),
        make.epoch(5, 6).alias("timestamp"),
        make.uuid().alias("user_id"),
        make.degrees(7, 90).alias("user_latitude"),
        make.degrees(8, 180).alias("user_longitude"),
        *make.month_and_date(5),
    )


def synth_viewership(ids: DataFrame, id_column: str, seed: int = 0) -> DataFrame:
    """One ``viewership`` row per id."""
    make = _Row(id_column, seed, slots=18)
    return make.over(ids).select(
        make.advertising_id(),
        make.pick(0, GENRES).alias("channel_genre"),
        make.pick(1, CHANNELS).alias("channel_name"),
        make.pick(2, CITIES).alias("city"),
        make.pick(3, DEVICES).alias("device"),
        make.pick(4, DEVICE_TYPES).alias("device_type"),
        make.number(5, 1000).alias("duration"),
        (make.number(6, 1001) + 1000).cast("string").alias("grid_id"),
        make.pick(7, LANGUAGES).alias("language"),
        make.pick(8, PLACES).alias("location_category"),
        make.pick(9, GRAINS).alias("location_granularities"),
        make.pick(10, ORIGINS).alias("location_source"),
        make.epoch(11, 12).alias("record_timestamp"),
        make.pick(13, FLAGS).alias("show_genre"),
        make.pick(14, FLAGS).alias("show_name"),
        make.pick(15, REGIONS).alias("state"),
        make.degrees(16, 90).alias("user_lat"),
        make.degrees(17, 180).alias("user_long"),
        *make.month_and_date(11),
    )


class _Row:
    """Column expressions over the digest of one row."""

    def __init__(self, id_column: str, seed: int, slots: int):
        self.id_column, self.seed = id_column, seed
        self.blocks = -(-slots // BLOCK)

    def over(self, ids: DataFrame) -> DataFrame:
        return ids.select(
            F.concat_ws("-", F.lit(str(self.seed)), F.col(self.id_column).cast("string")).alias("_name")
        ).withColumns(
            {f"_block{b}": F.sha2(F.concat(F.col("_name"), F.lit(f"-{b}")), 256) for b in range(self.blocks)}
        )

    def number(self, slot: int, below: int) -> Column:
        block, place = divmod(slot, BLOCK)
        digits = F.substring(f"_block{block}", place * SLOT + 1, SLOT)
        return F.conv(digits, 16, 10).cast("bigint") % below

    def pick(self, slot: int, words: Sequence[str]) -> Column:
        listed = F.array(*[F.lit(w) for w in words])
        return F.element_at(listed, (self.number(slot, len(words)) + 1).cast("int"))

    def degrees(self, slot: int, limit: int) -> Column:
        return self.number(slot, limit * 2000).cast("double") / 1000.0 - float(limit)

    def day(self, slot: int) -> Column:
        return F.date_add(F.lit(FIRST_DAY).cast("date"), self.number(slot, DAYS).cast("int"))

    def month_and_date(self, slot: int) -> list[Column]:
        day = self.day(slot)
        return [F.date_format(day, "MM").alias("month"), F.date_format(day, "yyyy-MM-dd").alias("date")]

    def epoch(self, day_slot: int, second_slot: int) -> Column:
        midnight = F.unix_date(self.day(day_slot)).cast("bigint") * 86400
        return midnight + self.number(second_slot, 86400)

    def advertising_id(self) -> Column:
        return F.sha1("_name").alias("advertising_id")

    def uuid(self) -> Column:
        return F.regexp_replace(F.md5("_name"), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
