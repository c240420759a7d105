"""Type strings of a dataset contract → Spark types."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# The type strings a contract may use, and the decimal defaults.
FLATTEN = "ArrayType-StringType"
_INTEGER = re.compile(r"^IntegerType(\(\))?$")
_DATE = re.compile(r"^DateType(\(\))?$")
_DECIMAL = re.compile(
    r"^DecimalType(?:\(\s*(?:(?P<precision>\d+)\s*,\s*(?P<scale>\d+)\s*)?\))?"
    r"(?:\s*,\s*(?P<short_scale>\d+))?$"
)
DECIMAL_PRECISION = 10
DECIMAL_SCALE = 7


def parse_type(text: str) -> T.DataType:
    """Spark type a contract column ends up with after casting.

    ``DecimalType``, ``DecimalType()``, ``DecimalType,S`` and ``DecimalType(P,S)``
    are all accepted; an unknown string is an error rather than a silent no-op.
    """
    spec = text.strip()
    if spec == FLATTEN:
        return T.StringType()
    if _INTEGER.match(spec):
        return T.IntegerType()
    if _DATE.match(spec):
        return T.DateType()
    found = _DECIMAL.match(spec)
    if found:
        precision = int(found["precision"] or DECIMAL_PRECISION)
        scale = found["scale"] or found["short_scale"] or DECIMAL_SCALE
        return T.DecimalType(precision, int(scale))
    raise ValueError(f"unsupported contract type: {text!r}")


def type_name(text: str) -> str:
    """Spark's short name of the target type, e.g. ``decimal(10,7)``."""
    return parse_type(text).simpleString()
