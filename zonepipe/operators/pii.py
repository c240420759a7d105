"""Identifier pairs (raw value next to its masked value) and audit columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepipe.functions import masked

# Column names of the lookup.
MASKED_PREFIX = "Masked_"
BEGIN, UPDATE, ACTIVE = "begin_date", "update_date", "flag_active"
AUDIT = (BEGIN, UPDATE, ACTIVE)


def as_date(day: dt.date | str) -> Column:
    return F.lit(str(day)).cast("date")


def no_date() -> Column:
    return F.lit(None).cast("date")


def pii_pairs(
    df: DataFrame, pii: Iterable[str], extra: Iterable[str] = (), pepper: str | None = None
) -> DataFrame:
    """Project ``x, Masked_x`` for every identifier the frame has, then ``extra``."""
    present = [c for c in pii if c in df.columns]
    pairs = [
        column
        for c in present
        for column in (F.col(c), masked(F.col(c), pepper).alias(MASKED_PREFIX + c))
    ]
    return df.select(*pairs, *[F.col(c) for c in extra if c not in present])


def audit_columns(df: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Mark rows as versions that begin on ``as_of`` and are still open."""
    return df.withColumns({BEGIN: as_date(as_of), UPDATE: no_date()})


def swap_masked(df: DataFrame, pii: Iterable[str]) -> DataFrame:
    """Drop raw identifiers and give their masked values the plain names."""
    pairs = [c for c in pii if MASKED_PREFIX + c in df.columns]
    return df.drop(*pairs).withColumnsRenamed({MASKED_PREFIX + c: c for c in pairs})
