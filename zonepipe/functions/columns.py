"""Column expressions used by the transform operators; all stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepipe.functions.types import FLATTEN, parse_type


def flatten_to_string(column: Column, source_type: T.DataType) -> Column:
    """Comma-joined text of an array column.

    NULL elements are skipped and a NULL array gives ``''``; a column that is
    already text passes through unchanged.
    """
    if isinstance(source_type, T.ArrayType) and not isinstance(source_type.elementType, T.StringType):
        column = column.cast(T.ArrayType(T.StringType()))
    return F.concat_ws(",", column)


def cast_to(column: Column, spec: str, source_type: T.DataType, strict: bool = False) -> Column:
    """``column`` brought to the contract type ``spec``.

    A value that does not fit becomes NULL; with ``strict`` it fails the job.
    """
    if spec.strip() == FLATTEN:
        return flatten_to_string(column, source_type)
    target = parse_type(spec)
    return column.cast(target) if strict else column.try_cast(target)


def masked(column: Column, pepper: str | None = None) -> Column:
    """SHA-256 hex of the value's text form; NULL stays NULL.

    ``pepper`` is an optional secret put in front of the value, for identifiers
    of low entropy whose plain hash could be guessed.
    """
    text = column.cast("string")
    if pepper:
        text = F.concat(F.lit(pepper), text)
    return F.sha2(text, 256)
