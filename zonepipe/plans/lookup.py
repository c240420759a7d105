"""One run of lookup maintenance."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from zonepipe.contract import Contract
from zonepipe.functions import cast_to
from zonepipe.operators.pii import ACTIVE, BEGIN, UPDATE, as_date, no_date, pii_pairs
from zonepipe.operators.scd2 import CHANGED, UNCHANGED, dedupe_batch, scd2_matched
from zonepipe.operators.splice import DROPPED, scd2_rebuilt, scd2_splice
from zonepipe.sources.files import remove
from zonepipe.sources.lookup import (
    CHANGE,
    CLOSED,
    DROPPED_CLOSED,
    DROPPED_OPEN,
    OPENED,
    OPENED_IN,
    SEEN,
    SPLICED,
    LookupStore,
    StaleRun,
    lookup_extra,
    stored_type,
)


@dataclass(frozen=True)
class RunCounts:
    """What one run did to the lookup."""

    version: int
    as_of: str
    new: int
    changed: int
    unchanged: int

    @property
    def updated(self) -> bool:
        return self.new + self.changed > 0


def lookup_batch(raw: DataFrame, contract: Contract, pepper: str | None = None) -> DataFrame:
    """Raw rows → one lookup row per key.

    Masks are computed after the reduction: once per key, and never shuffled.
    """
    slim = lookup_columns(raw, contract)
    pii = [c for c in contract.pii if c in slim.columns]
    latest = dedupe_batch(slim, contract.keys, contract.recency)
    return pii_pairs(latest, pii, lookup_extra(contract), pepper)


def lookup_columns(raw: DataFrame, contract: Contract) -> DataFrame:
    """The key, identifier, tracked and recency columns of raw rows, typed as the lookup stores them.

    A contract cast comes before the text an identifier is stored as, like in staging,
    so that both mask the same text.
    """
    step = contract.transform
    rows = raw.withColumnsRenamed(dict(step.rename)) if step.rename else raw
    pii = [c for c in contract.pii if c in rows.columns]
    extra = lookup_extra(contract)

    def typed(column: str):
        value = F.col(column)
        if column in step.casts and (column in pii or column in extra):
            value = cast_to(value, step.casts[column], rows.schema[column].dataType)
        if column in pii:
            value = value.cast("string")
        elif column in extra:
            value = value.cast(stored_type(column, contract))
        return value.alias(column)

    return rows.select(*map(typed, dict.fromkeys([*contract.keys, *pii, *extra, *contract.recency])))


def update_lookup(
    spark: SparkSession,
    raw: DataFrame,
    contract: Contract,
    as_of: dt.date | str,
    version: int,
    pepper: str | None = None,
    feed: str = "batch",
    keep_batch: bool = False,
) -> RunCounts:
    """Merge ``raw`` into the stored lookup as run ``version``; always commits the run.

    The batch is reduced and written first, so the planner knows its size: it broadcasts a
    small one and leaves the open versions where they are, or shuffles it to the buckets of
    their snapshot, which stays where it is as well.  What
    either finds is written as well, so nothing is evaluated twice, and the run itself
    writes the versions it opens and closes and nothing else.  A first run only opens
    versions and needs neither.

    Counts are observed on rows being written, after the last shuffle, so a recomputed
    stage cannot count twice.  ``keep_batch`` stores the reduced batch with the run, for
    ``update_in_any_order``.
    """
    store = LookupStore.of(spark, contract)
    store.check_order(version, as_of)
    store.claim(feed)
    batch = lookup_batch(raw, contract, pepper)
    begun = {BEGIN: as_date(as_of), UPDATE: no_date(), ACTIVE: F.lit(True), OPENED_IN: F.lit(version).cast("long")}
    if not any(v < version for v in store.versions()):
        opened = Observation()
        first = batch.observe(opened, F.count(F.lit(1)).alias("n")).withColumns(begun)
        if keep_batch:
            first = first.withColumn(CHANGE, F.explode(F.array(F.lit(OPENED), F.lit(SEEN))))
        store.write(first, version, as_of)
        return RunCounts(version, str(as_of), opened.get.get("n") or 0, 0, 0)

    scratch = f"{store.path}/_run_{version}"
    read, met = Observation(), Observation()
    try:
        batch = _kept(batch.observe(read, F.count(F.lit(1)).alias("n")), f"{scratch}/batch")
        matched = matched_versions(store, batch, contract, version)
        by_status = [F.count_if(F.col("status") == s).alias(s) for s in (CHANGED, UNCHANGED)]
        matched = _kept(matched.observe(met, *by_status), f"{scratch}/matched")
        fresh = batch.join(matched.select(*contract.keys), list(contract.keys), "left_anti")

        changed = matched.filter(F.col("status") == CHANGED)
        opened = fresh.unionByName(changed.select("cur.*")).withColumns(begun)
        closed = changed.select("old.*").withColumns({UPDATE: as_date(as_of), ACTIVE: F.lit(False)})
        changes = opened.unionByName(closed)
        if keep_batch:
            changes = changes.withColumn(CHANGE, F.when(F.col(ACTIVE), OPENED).otherwise(CLOSED))
            changes = changes.unionByName(batch.withColumns({**begun, CHANGE: F.lit(SEEN)}))
        store.write(changes, version, as_of)
    finally:
        remove(spark, scratch)
    n_changed, n_unchanged = (met.get.get(s) or 0 for s in (CHANGED, UNCHANGED))
    return RunCounts(
        version, str(as_of), (read.get.get("n") or 0) - n_changed - n_unchanged, n_changed, n_unchanged
    )


def update_in_any_order(
    spark: SparkSession,
    raw: DataFrame,
    contract: Contract,
    as_of: dt.date | str,
    version: int,
    pepper: str | None = None,
) -> RunCounts:
    """Merge ``raw`` as run ``version``, also where ``as_of`` is not after all earlier runs' dates.

    The lookup is the one that runs in the order of their dates would have made; of two
    batches of a date, the later run's row of a key counts.  Every run keeps its batch; a
    lookup with runs that did not takes no late ones.  A late run rebuilds the versions of
    its own keys and writes those that differ.  It reads the kept batches once, and shuffles
    what they and the lookup hold of its keys.

    In the counts of a late run, changed keys are those with any version that differs.
    """
    store = LookupStore.of(spark, contract)
    latest = store.latest_day(before=version)
    if not store.keeps_batches(before=version):
        raise StaleRun(f"{store.path} has runs that kept no batch: nothing can be spliced in")
    if latest is None or str(as_of) > latest:
        return update_lookup(spark, raw, contract, as_of, version, pepper, keep_batch=True)
    store.check_order(version, as_of, late=True)
    store.claim("batch")

    keys, scratch = list(contract.keys), f"{store.path}/_run_{version}"
    begun = {BEGIN: as_date(as_of), UPDATE: no_date(), ACTIVE: F.lit(True), OPENED_IN: F.lit(version).cast("long")}
    read = Observation()
    try:
        batch = lookup_batch(raw, contract, pepper).observe(read, F.count(F.lit(1)).alias("n"))
        batch = _kept(batch.withColumns(begun), f"{scratch}/batch")
        touched = batch.select(*keys)
        before = _kept(store.seen(before=version).join(touched, keys, "left_semi"), f"{scratch}/seen")
        rows = [df.drop(UPDATE, ACTIVE).withColumnRenamed(BEGIN, "_run") for df in (before, batch)]
        rebuilt = scd2_rebuilt(*rows, keys, contract.tracked, "_run", OPENED_IN)
        stored = store.versions_before(version).join(touched, keys, "left_semi").select(*store.schema.names, OPENED_IN)
        moves = scd2_splice(stored, rebuilt.select(*store.schema.names), keys)
        dropped = F.when(F.col(ACTIVE), DROPPED_OPEN).otherwise(DROPPED_CLOSED)
        written = F.when(F.col(ACTIVE), OPENED).otherwise(SPLICED)
        moves = moves.withColumns(
            {
                CHANGE: F.when(F.col("splice") == DROPPED, dropped).otherwise(written),
                OPENED_IN: F.coalesce(OPENED_IN, F.lit(version).cast("long")),
            }
        )
        moves = _kept(moves.drop("splice"), f"{scratch}/moves")
        n_moved = moves.select(*keys).distinct().count()
        n_known = before.select(*keys).distinct().count()
        store.write(moves.unionByName(batch.withColumn(CHANGE, F.lit(SEEN))), version, as_of, late=True)
    finally:
        remove(spark, scratch)
    # Keys that no batch has shown before are new, and all of them have moved.
    n_read = read.get.get("n") or 0
    n_new = n_read - n_known
    return RunCounts(version, str(as_of), n_new, n_moved - n_new, n_known - (n_moved - n_new))


def matched_versions(store: LookupStore, batch: DataFrame, contract: Contract, version: int) -> DataFrame:
    """Open versions that the batch's keys have, with what the batch does to them.

    Every stored part of the open versions meets the batch by itself, so a bucketed snapshot
    is neither moved nor united with anything; versions closed since are taken out of what
    was found, which is no larger than the batch.
    """
    parts, gone = store.open_parts(before=version)
    found = [scd2_matched(part, batch, contract.keys, contract.tracked, carried=[OPENED_IN]) for part in parts]
    matched = reduce(DataFrame.unionByName, found)
    if gone is not None:
        matched = matched.join(gone, [*contract.keys, OPENED_IN], "left_anti")
    return matched.drop(OPENED_IN)


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
