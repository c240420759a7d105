"""Data checks as aggregates.

Verdicts share one schema, ``check, subject, expected, actual, passed``, one row
per checked thing, so several checks can be unioned, stored or turned into a gate
with ``raise_on_failure``.  Every check is one aggregate with map-side partials.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepipe.contract import Contract
from zonepipe.functions import FLATTEN, cast_to, type_name

VERDICT = ("check", "subject", "expected", "actual", "passed")


class QualityError(Exception):
    """A gate found failed checks."""


def validate_counts(df: DataFrame) -> DataFrame:
    """One row: all rows, and rows with a value in the first column."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(df.columns[0]).alias("n_values")
    )


def count_by_file(df: DataFrame) -> DataFrame:
    """Rows per file of a freshly scanned zone; the sum is the dataset's count."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def count_by_partition(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows and first-column values per partition directory."""
    return df.groupBy(*partitions).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(df.columns[0]).alias("n_values")
    )


def validate_availability(df: DataFrame, subject: str) -> DataFrame:
    """Fails when the first column holds no value at all."""
    return _rows(df, [_availability(df.columns[0], subject)])


def validate_reconcile(before: DataFrame, after: DataFrame, subject: str) -> DataFrame:
    """Compares first-column counts of two zones."""
    sides = before.agg(F.count(before.columns[0]).alias("n"), F.lit("before").alias("side")).unionByName(
        after.agg(F.count(after.columns[0]).alias("n"), F.lit("after").alias("side"))
    )
    n_before, n_after = (F.max(F.when(F.col("side") == s, F.col("n"))) for s in ("before", "after"))
    return _rows(sides, [_reconcile(subject, n_before, n_after)])


def validate_arrivals(df: DataFrame, arrivals: DataFrame, counted: DataFrame) -> DataFrame:
    """One verdict per arrival: it fails when it brought no row with a value in the first column.

    ``arrivals`` names all of them (column ``arrival``), so one without any row is
    found too; ``counted`` is ``df`` with the arrival of each row.
    """
    n = counted.groupBy("arrival").agg(F.count(df.columns[0]).alias("n"))
    found = F.coalesce("n", F.lit(0))
    return arrivals.join(n, "arrival", "left").select(
        F.lit("availability").alias("check"),
        F.col("arrival").alias("subject"),
        F.lit("> 0").alias("expected"),
        found.cast("string").alias("actual"),
        (found > 0).alias("passed"),
    )


def validate_types(df: DataFrame, contract: Contract) -> DataFrame:
    """Contract type against actual type per cast column.

    A missing column, or a frame without rows, has no actual type and fails.
    """
    return _rows(df, _types(df, contract))


def validate_cast_loss(raw: DataFrame, contract: Contract) -> DataFrame:
    """Values present in ``raw`` that the contract's cast would turn into NULL."""
    return _rows(raw, _cast_loss(raw, contract))


def validate_raw(raw: DataFrame, contract: Contract, count_rows: bool = False) -> DataFrame:
    """All checks of a raw zone in one pass over the columns they need.

    Availability is a gate; cast loss and NULL lookup keys are reported, and with
    ``count_rows`` the number of rows.
    """
    null_keys = [
        _verdict("null_key", key, F.lit("0"), n.cast("string"), n == 0)
        for key in contract.keys
        for n in [F.count_if(F.col(key).isNull())]
    ]
    checks = [_availability(raw.columns[0], contract.dataset), *_cast_loss(raw, contract), *null_keys]
    if count_rows:
        n = F.count(F.lit(1))
        checks.append(_verdict("rows", contract.dataset, F.lit("> 0"), n.cast("string"), n > 0))
    return _rows(raw, checks)


def validate_staging(
    staged: DataFrame,
    contract: Contract,
    column: str,
    expected: int,
    expected_rows: int | None = None,
    partition_text: Mapping[str, str] | None = None,
    counted: bool = False,
) -> DataFrame:
    """All checks of a staging zone in one pass: availability, count, types.

    With ``expected_rows`` all rows are counted too, and with ``partition_text`` (partition
    column → column that holds its value as text) so are values its type cannot take.
    With ``counted`` a row of ``staged`` stands for ``n_rows`` rows, ``n_values`` of them with a
    value in ``column``.
    """
    n_values = _sum("n_values") if counted else F.count(column)
    checks = [
        _available(contract.dataset, n_values),
        _reconcile(contract.dataset, F.lit(expected), n_values),
        *_types(staged, contract),
    ]
    if expected_rows is not None:
        n = _sum("n_rows") if counted else F.count(F.lit(1))
        checks.append(
            _verdict("row_count", contract.dataset, F.lit(str(expected_rows)), n.cast("string"), n == expected_rows)
        )
    for name, text in (partition_text or {}).items():
        lost = F.col(text).isNotNull() & F.col(name).isNull()
        bad = _sum(F.when(lost, F.col("n_rows"))) if counted else F.count_if(lost)
        checks.append(_verdict("partition_value", name, F.lit("0"), bad.cast("string"), bad == 0))
    return _rows(staged, checks)


def validate_columns(df: DataFrame, contract: Contract) -> list[str]:
    """Contract columns the frame lacks (a driver-side look at the schema)."""
    step = contract.transform
    present = {step.rename.get(c, c) for c in df.columns}
    needed = [*step.casts, *step.masks, *step.partitions, *contract.keys, *contract.tracked]
    return [c for c in dict.fromkeys(needed) if c not in present]


def raise_on_failure(verdicts: DataFrame, report_only: Sequence[str] = ()) -> list:
    """Run the checks; raise ``QualityError`` naming the failed ones, else return all rows.

    Checks named in ``report_only`` never raise.
    """
    rows = verdicts.collect()  # one row per check, bounded by the contract's columns
    failed = [r for r in rows if not r["passed"] and r["check"] not in report_only]
    if failed:
        raise QualityError(
            "; ".join(
                f"{r['check']}({r['subject']}): expected {r['expected']}, got {r['actual']}"
                for r in failed
            )
        )
    return rows


def empty_verdicts(df: DataFrame) -> DataFrame:
    kinds = {"passed": T.BooleanType()}
    schema = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in VERDICT])
    return df.sparkSession.createDataFrame([], schema)


def _verdict(check: str, subject: str, expected: Column, actual: Column, passed: Column) -> tuple:
    return F.lit(check), F.lit(subject), expected, actual, passed


def _availability(column: str, subject: str) -> tuple:
    return _available(subject, F.count(column))


def _available(subject: str, found: Column) -> tuple:
    return _verdict("availability", subject, F.lit("> 0"), found.cast("string"), found > 0)


def _sum(counts: Column | str) -> Column:
    return F.coalesce(F.sum(counts), F.lit(0))


def _reconcile(subject: str, before: Column, after: Column) -> tuple:
    return _verdict(
        "reconcile", subject, before.cast("string"), after.cast("string"), before == after
    )


def _types(df: DataFrame, contract: Contract) -> list[tuple]:
    rows = []
    for column, spec in contract.transform.casts.items():
        expected = type_name(spec)
        known = F.typeof(F.col(column)) if column in df.columns else F.lit(None).cast("string")
        actual = F.max(known)
        passed = F.coalesce(actual == expected, F.lit(False))
        rows.append(_verdict("type", column, F.lit(expected), actual, passed))
    return rows


def _cast_loss(raw: DataFrame, contract: Contract) -> list[tuple]:
    rows = []
    for column, spec in contract.transform.casts.items():
        if spec.strip() == FLATTEN:
            continue
        value = F.col(column)
        lost = value.isNotNull() & cast_to(value, spec, raw.schema[column].dataType).isNull()
        n = F.count_if(lost)
        rows.append(_verdict("cast_loss", column, F.lit("0"), n.cast("string"), n == 0))
    return rows


def _rows(df: DataFrame, verdicts: Sequence[tuple]) -> DataFrame:
    """Evaluate all verdicts in one aggregate and lay them out as rows."""
    if not verdicts:
        return empty_verdicts(df)
    wide = df.agg(
        F.array(
            *[F.struct(*[c.alias(n) for c, n in zip(v, VERDICT)]) for v in verdicts]
        ).alias("verdicts")
    )
    return wide.select(F.inline("verdicts"))
