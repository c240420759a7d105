"""Raw → staging projections: contract casts, array flattening, masking.

Each operator is one projection; Catalyst collapses the chain into a single
``Project`` over the scan, so a full transform is a map-only, codegen'd pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepipe.contract import Contract
from zonepipe.functions import cast_to, masked, parse_type

#: Partitions that rebalanced rows are dealt to at least; beyond it Spark keeps only average sizes of them.
SPREAD = 2000


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    """Fail early, naming every contract column the frame lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the data: {missing}")


def cast_columns(df: DataFrame, casts: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Bring each column in ``casts`` to its contract type."""
    require_columns(df, casts)
    return df.withColumns(
        {c: cast_to(F.col(c), spec, df.schema[c].dataType, strict) for c, spec in casts.items()}
    )


def mask_columns(df: DataFrame, columns: Iterable[str], pepper: str | None = None) -> DataFrame:
    """Replace each column by its SHA-256 hex, in place."""
    columns = list(columns)
    require_columns(df, columns)
    return df.withColumns({c: masked(F.col(c), pepper) for c in columns})


def spread(df: DataFrame, by: str) -> DataFrame:
    """Rows rebalanced by a column, so that adaptive execution packs its small values and splits hot ones.

    A partition that is split writes a file of each of its values for every piece.  So that only
    a hot value is split and not many small ones that share a partition, the rows are dealt to
    many partitions, which adaptive execution merges where they are small.
    """
    conf = df.sparkSession.conf
    merges = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled")
    if not all(conf.get(c).lower() == "true" for c in merges):
        return df.hint("rebalance", by)
    asked = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return df.hint("rebalance", max(SPREAD, int(asked or 0), int(conf.get("spark.sql.shuffle.partitions"))), by)


def transform(
    df: DataFrame,
    contract: Contract,
    strict: bool = False,
    pepper: str | None = None,
    spread_by: str | None = None,
) -> DataFrame:
    """Rename, cast, then mask, as the contract says.

    ``spread_by`` rebalances the rows by that column first: hashes are longer
    than the identifiers they replace, so it is the raw rows that should travel.
    """
    step = contract.transform
    rows = df.withColumnsRenamed(dict(step.rename)) if step.rename else df
    if spread_by:
        rows = spread(rows, spread_by)
    return mask_columns(cast_columns(rows, step.casts, strict), step.masks, pepper)


def staged_schema(raw: T.StructType, contract: Contract) -> T.StructType:
    """Schema of the staging zone, partition columns last.

    Readers pass it explicitly: partition values are text in paths, and guessing
    their types would turn month ``01`` into the number 1.
    """
    step = contract.transform
    fields = []
    for field in raw.fields:
        name = step.rename.get(field.name, field.name)
        if name in step.masks:
            kind = T.StringType()
        elif name in step.casts:
            kind = parse_type(step.casts[name])
        else:
            kind = field.dataType
        fields.append(T.StructField(name, kind, True))
    data = [f for f in fields if f.name not in step.partitions]
    by_name = {f.name: f for f in fields}
    return T.StructType(data + [by_name[p] for p in step.partitions])
