"""Type 2 slowly-changing lookup as DataFrame algebra.

Shapes
------
*batch*   one row per key (``dedupe_batch``): lookup columns without audit columns.
*active*  the open versions of the lookup: at most one row per key.
*lookup*  all versions: batch columns + ``begin_date, update_date, flag_active``.

Plan notes
----------
Both sides of every join hold at most one row per key, so no join key can be hot.
The only place a hot key may appear is the raw batch, and there ``dedupe_batch``
keeps the best row per key inside each map task before anything is shuffled.
The stored lookup never joins nor shuffles closed history; ``scd2_merge``, which takes a
whole lookup as one frame, lets it pass through its one join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonepipe.operators.pii import ACTIVE, AUDIT, BEGIN, UPDATE, as_date, audit_columns, no_date

NEW, CHANGED, UNCHANGED = "new", "changed", "unchanged"


def dedupe_batch(batch: DataFrame, keys: Sequence[str], recency: Sequence[str]) -> DataFrame:
    """The latest row of each key; rows without a key are left out.

    Ties on ``recency`` are broken by the remaining columns, so the choice
    depends on the data alone and not on how it is partitioned.  Ranking with
    ``row_number() = 1`` lets Spark apply a per-task group limit before the
    exchange: a key with a third of all rows still sends one row per task.
    """
    rest = [c for c in batch.columns if c not in keys and c not in recency]
    latest = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in [*recency, *rest]]
    )
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (
        batch.filter(keyed)
        .withColumn("_rank", F.row_number().over(latest))
        .filter("_rank = 1")
        .drop("_rank")
    )


def lookup_active(lookup: DataFrame) -> DataFrame:
    """Open versions only."""
    return lookup.filter(F.col(ACTIVE))


def scd2_initial(batch: DataFrame, as_of: dt.date | str) -> DataFrame:
    """First load: every batch row opens a version."""
    return audit_columns(batch, as_of).withColumn(ACTIVE, F.lit(True))


def scd2_new_keys(active: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key has no open version."""
    return batch.join(active.select(*keys), list(keys), "left_anti").select(*batch.columns)


def scd2_change_rows(
    active: DataFrame, batch: DataFrame, keys: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """Batch rows whose key is open with a different tracked value (NULL-safe)."""
    before, after = _tagged(active, keys, tracked), batch.alias("batch")
    on = _same_key(keys)
    return after.join(before, on, "inner").filter(_differs(tracked)).select("batch.*")


def scd2_changes(
    active: DataFrame, batch: DataFrame, keys: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """Batch rows that will open a version: changed rows and new keys."""
    labelled = scd2_classify(active, batch, keys, tracked)
    return labelled.filter(F.col("status") != UNCHANGED).drop("status")


def scd2_classify(
    active: DataFrame, batch: DataFrame, keys: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """Batch rows with a ``status`` of new, changed or unchanged."""
    before, after = _tagged(active, keys, tracked), batch.alias("batch")
    status = (
        F.when(F.col("active._known").isNull(), NEW)
        .when(_differs(tracked), CHANGED)
        .otherwise(UNCHANGED)
    )
    return after.join(before, _same_key(keys), "left").select("batch.*", status.alias("status"))


def scd2_change_summary(
    active: DataFrame, batch: DataFrame, keys: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """One row: how many batch rows are new, changed and unchanged."""
    status = F.col("status")
    return scd2_classify(active, batch, keys, tracked).agg(
        *[F.count_if(status == s).alias(f"n_{s}") for s in (NEW, CHANGED, UNCHANGED)]
    )


def scd2_pairing(
    lookup: DataFrame, batch: DataFrame, keys: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """Versions and batch rows side by side: open ones meet the batch row of their key.

    ``old`` and ``cur`` are structs, NULL where that side has no row, so presence
    never has to be read off a nullable data column.  ``status`` is NULL for versions
    the batch does not touch.  One full outer join; closed versions meet nothing and
    pass through it, so either input is evaluated once.
    """
    old = lookup.select(*_packed(lookup.columns, keys, "old"))
    cur = batch.select(*_packed(batch.columns, keys, "cur"))
    same = reduce(lambda a, b: a & b, [F.col(f"_old_{k}") == F.col(f"_cur_{k}") for k in keys])
    pairs = old.join(cur, same & F.col(f"old.{ACTIVE}"), "full_outer").select("old", "cur")
    return pairs.withColumn("status", _status(tracked))


def scd2_matched(
    active: DataFrame, batch: DataFrame, keys: Sequence[str], tracked: Sequence[str], carried: Sequence[str] = ()
) -> DataFrame:
    """Keys on both sides with their ``status``; ``old`` and ``cur`` only where they differ.

    ``carried`` names columns of ``active`` that come along in any case.

    An inner join, so the planner may broadcast whichever side is small and leave the
    other where it is.
    """
    old = active.select(*_packed(active.columns, keys, "old"))
    cur = batch.select(*_packed(batch.columns, keys, "cur"))
    same = reduce(lambda a, b: a & b, [F.col(f"_old_{k}") == F.col(f"_cur_{k}") for k in keys])
    changed = F.col("status") == CHANGED
    return (
        old.join(cur, same)
        .withColumn("status", _status(tracked))
        .select(
            *[F.col(f"_cur_{k}").alias(k) for k in keys],
            "status",
            *[F.col(f"old.{c}").alias(c) for c in carried],
            *[F.when(changed, F.col(side)).alias(side) for side in ("old", "cur")],
        )
    )


def scd2_apply(pairing: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Versions after one run.

    A pair yields the kept or closed old version, the newly opened one, or both;
    they come out of the same row, so the join is evaluated once.
    """
    lookup_columns = pairing.schema["old"].dataType.names
    batch_columns = pairing.schema["cur"].dataType.names
    changed = F.col("status").eqNullSafe(CHANGED)
    replaced = {
        UPDATE: F.when(changed, as_date(as_of)).otherwise(F.col(f"old.{UPDATE}")),
        ACTIVE: F.when(changed, F.lit(False)).otherwise(F.col(f"old.{ACTIVE}")),
    }
    opened = {BEGIN: as_date(as_of), UPDATE: no_date(), ACTIVE: F.lit(True)}
    old = F.struct(*[replaced.get(c, F.col(f"old.{c}")).alias(c) for c in lookup_columns])
    new = F.struct(
        *[
            (F.col(f"cur.{c}") if c in batch_columns else opened[c]).alias(c)
            for c in lookup_columns
        ]
    )
    versions = (
        F.when(changed, F.array(old, new))
        .when(F.col("old").isNotNull(), F.array(old))
        .otherwise(F.array(new))
    )
    return pairing.select(F.inline(versions))


def scd2_step(
    active: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: dt.date | str,
) -> DataFrame:
    """What one run writes: open versions after the run plus those it closed."""
    return scd2_apply(scd2_pairing(active, batch, keys, tracked), as_of)


def scd2_closed(step: DataFrame) -> DataFrame:
    """Versions closed by the run."""
    return step.filter(~F.col(ACTIVE))


def scd2_inserted(
    active: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: dt.date | str,
) -> DataFrame:
    """Versions opened by the run."""
    return scd2_initial(scd2_changes(active, batch, keys, tracked), as_of)


def scd2_merge(
    lookup: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: dt.date | str,
) -> DataFrame:
    """The whole lookup after one run, history included."""
    return scd2_apply(scd2_pairing(lookup, batch, keys, tracked), as_of)


def scd2_history(
    batches: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    recency: Sequence[str],
    run: str,
) -> DataFrame:
    """The lookup after merging one batch per value of the date column ``run``, in order.

    Equal to a loop of ``scd2_merge`` but in one job: reduce to one row per
    (key, run), keep rows whose tracked values differ from the key's previous
    run, and end each version where the next begins.  The first exchange carries
    already reduced rows; the second at most one row per key and run.
    """
    per_run = dedupe_batch(batches, [*keys, run], recency)
    in_order = Window.partitionBy(*keys).orderBy(run)
    before = {f"_before_{c}": F.lag(c).over(in_order) for c in (run, *tracked)}
    moved = [~F.col(c).eqNullSafe(F.col(f"_before_{c}")) for c in tracked]
    starts = per_run.withColumns(before).filter(
        F.col(f"_before_{run}").isNull() | _any(moved)
    )
    columns = [c for c in batches.columns if c != run and c not in recency]
    versions = starts.select(
        *columns, F.col(run).alias(BEGIN), F.lead(run).over(in_order).alias(UPDATE)
    )
    return versions.withColumn(ACTIVE, F.col(UPDATE).isNull())


def batch_columns(lookup_columns: Sequence[str]) -> list[str]:
    """Lookup columns a batch has to bring, i.e. all but the audit columns."""
    return [c for c in lookup_columns if c not in AUDIT]


def _status(tracked: Sequence[str]) -> Column:
    """What the batch row ``cur`` does to the open version ``old``."""
    differs = _any([~F.col(f"old.{c}").eqNullSafe(F.col(f"cur.{c}")) for c in tracked])
    return (
        F.when(F.col("cur").isNull(), F.lit(None))
        .when(F.col("old").isNull(), NEW)
        .when(differs, CHANGED)
        .otherwise(UNCHANGED)
    )


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _packed(columns: Sequence[str], keys: Sequence[str], name: str) -> list[Column]:
    side = F.struct(*[F.col(c) for c in columns]).alias(name)
    return [*[F.col(k).alias(f"_{name}_{k}") for k in keys], side]


def _tagged(active: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    wanted = list(dict.fromkeys([*keys, *tracked]))
    return active.select(*wanted, F.lit(True).alias("_known")).alias("active")


def _same_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"batch.{k}") == F.col(f"active.{k}") for k in keys])


def _differs(tracked: Sequence[str]) -> Column:
    return _any([~F.col(f"batch.{c}").eqNullSafe(F.col(f"active.{c}")) for c in tracked])
