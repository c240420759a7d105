"""Zone-to-zone data preparation with personal-identifier masking and a type 2 lookup, on Spark.

The package is a set of DataFrame → DataFrame operators plus thin jobs that
chain them.  Nothing here runs row-at-a-time Python: every operator is made of
built-in column expressions, joins, windows and aggregates.
"""

from zonepipe.contract import Contract, ZoneStep

__all__ = ["Contract", "ZoneStep"]
