"""Column-level building blocks (no DataFrame, no shuffle)."""

from zonepipe.functions.columns import cast_to, flatten_to_string, masked
from zonepipe.functions.types import FLATTEN, parse_type, type_name

__all__ = ["FLATTEN", "cast_to", "flatten_to_string", "masked", "parse_type", "type_name"]
