"""Late batches spliced into type 2 versions.

A batch of an earlier date than the newest may begin a version in the middle of another,
end one sooner, or make two into one.  Which of these depends on what earlier batches have
shown of the key, also where they changed nothing, so the versions of the keys in the batch
are rebuilt from all batches kept of them, and compared with those there are.  Other keys
are not touched, and versions that stay as they were are not written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepipe.operators.pii import BEGIN
from zonepipe.operators.scd2 import scd2_history

#: What splicing does with a version.
DROPPED, WRITTEN = "dropped", "written"


def scd2_rebuilt(
    seen: DataFrame, late: DataFrame, keys: Sequence[str], tracked: Sequence[str], run: str, order: str
) -> DataFrame:
    """Versions of the keys in ``late``, from its rows and all ``seen`` of these keys.

    Both hold one row per key and batch, with the batch's date ``run``; of two batches of a
    date, the one later in ``order`` counts.
    """
    touched = late.select(*keys).distinct()
    batches = seen.join(touched, list(keys), "left_semi").unionByName(late)
    return scd2_history(batches, keys, tracked, (order,), run)


def scd2_splice(versions: DataFrame, rebuilt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The difference between stored and rebuilt versions of the same keys.

    ``versions`` may hold further columns than ``rebuilt``.  The result has the columns of
    ``versions`` and ``splice``: versions that are ``dropped``, and ``written`` ones, whose
    further columns are null.  One full outer join on the key and the version's begin, of
    which no side has two.
    """
    known = rebuilt.columns
    on = [*keys, BEGIN]
    was = versions.select(*on, F.struct(*known).alias("_was"), F.struct(*versions.columns).alias("_stored"))
    now = rebuilt.select(*on, F.struct(*known).alias("_now"))
    types = {f.name: f.dataType for f in versions.schema.fields}
    written = F.struct(
        *[(F.col(f"_now.{c}") if c in known else F.lit(None)).cast(types[c]).alias(c) for c in versions.columns]
    )
    moves = F.array(
        F.struct(F.lit(DROPPED).alias("splice"), F.col("_stored").alias("row")),
        F.struct(F.lit(WRITTEN).alias("splice"), written.alias("row")),
    )
    there = {DROPPED: F.col("_was").isNotNull(), WRITTEN: F.col("_now").isNotNull()}
    return (
        was.join(now, on, "full_outer")
        .where(~F.col("_was").eqNullSafe(F.col("_now")))
        .select(*[there[s].alias(f"_{s}") for s in there], F.explode(moves).alias("move"))
        .where(F.when(F.col("move.splice") == DROPPED, F.col(f"_{DROPPED}")).otherwise(F.col(f"_{WRITTEN}")))
        .select("move.row.*", "move.splice")
    )
