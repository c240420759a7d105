"""Removal of repeated lines by overlapping three-line windows.

Every run of three lines is a window, known by a 128-bit hash of its lines.  The first
occurrence of a window over all documents stays; each later one covers its three lines,
overlapping covered positions are merged, and covered lines go.

Only windows that occur at least twice are joined back to their occurrences.  Counting
them and finding the first is partially aggregated, so a window that a third of all
documents hold reaches a reducer as one row per task; adaptive execution splits the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zonepipe.llm.common import unused, written

WINDOW = 3


def lines(text: str | Column) -> Column:
    return F.split(F.col(text) if isinstance(text, str) else text, "\n")


def _hashed(lines: Column, seed: int) -> Column:
    """One hash per line; both seeds together make 128 bits."""
    return F.transform(lines, lambda line: F.xxhash64(F.lit(seed), line))


def _windows(rows: DataFrame, window: int) -> DataFrame:
    """``id, row, at, one, two``: every window with its place and the two halves of its hash."""
    hashed = rows.select("id", "row", _hashed(F.col("lines"), 1).alias("h1"), _hashed(F.col("lines"), 2).alias("h2"))
    hashed = hashed.where(F.size("h1") >= window)
    starts = F.sequence(F.lit(0), F.size("h1") - window)

    def of(array: str, at: Column) -> Column:
        return F.xxhash64(*[F.get(F.col(array), at + k) for k in range(window)])

    pieces = F.transform(starts, lambda at: F.struct(of("h1", at).alias("one"), of("h2", at).alias("two")))
    return hashed.select("id", "row", F.posexplode(pieces).alias("at", "w")).select("id", "row", "at", "w.one", "w.two")


def repeated_runs(rows: DataFrame, window: int) -> DataFrame:
    """``id, row, runs``: sorted, disjoint runs of covered lines, for rows that have any."""
    windows = written(_windows(rows, window), "windows")
    place = F.struct("id", "row", "at")
    repeated = (
        windows.groupBy("one", "two")
        .agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("one").alias("w1"), F.col("two").alias("w2"), "first")
    )
    # The join is on one half, the other being a filter: no side has the count's exchange, which
    # could not be split, so adaptive execution deals a hot window to many tasks.
    same = (F.col("one") == F.col("w1")) & (F.col("two") <= F.col("w2")) & (F.col("two") >= F.col("w2"))
    later = windows.join(repeated, same).where(place > F.col("first"))
    inside = Window.partitionBy("id", "row").orderBy("at")
    fresh = F.coalesce(F.col("at") > F.lag("at").over(inside) + window, F.lit(True))
    runs = (
        later.select("id", "row", "at")
        .distinct()
        .withColumn("fresh", fresh.cast("int"))
        .withColumn("run", F.sum("fresh").over(inside))
        .groupBy("id", "row", "run")
        .agg(F.min("at").alias("start"), (F.max("at") + window).alias("stop"))
    )
    return runs.groupBy("id", "row").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("runs"))


def without_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """``df`` with covered lines cut from its text, plus ``n_lines`` and ``n_removed``.

    Order is by id, null first, then by a hash of the text, then by position.  Texts with
    fewer lines than a window stay whole; a null text stays null and has no lines; an empty
    text is one empty line.  Rows that repeat an id and text count as one document: they
    lose the same lines.  An empty table gives an empty result.  Columns of ``df`` named
    like the counts are replaced.
    """
    columns = [c for c in df.columns if c not in ("n_lines", "n_removed")]
    row, parts, runs, cut_id, cut_row = unused(df, "row_", "lines_", "runs_", "cut_id_", "cut_row_")
    keyed = df.select(*columns).withColumn(row, F.xxhash64(text_col))
    rows = keyed.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(row).alias("row"), lines(text_col).alias("lines")
    )
    cut = written(
        repeated_runs(rows, window).select(F.col("id").alias(cut_id), F.col("row").alias(cut_row), F.col("runs").alias(runs)),
        "runs",
    )
    # Runs grow with the corpus: the same shuffle at every size, never a broadcast of them.
    found = keyed.join(cut.hint("merge"), F.col(id_col).eqNullSafe(F.col(cut_id)) & (F.col(row) == F.col(cut_row)), "left").withColumn(
        parts, lines(text_col)
    )
    n_runs, n_lines = F.size(runs), F.size(parts)

    def between(k: Column) -> Column:
        """Lines after run ``k`` and before the next."""
        start = F.when(k == 0, F.lit(0)).otherwise(F.get(F.col(runs), k - 1)["stop"])
        stop = F.when(k == n_runs, n_lines).otherwise(F.get(F.col(runs), k)["start"])
        return F.slice(F.col(parts), start + 1, stop - start)

    kept = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), n_runs), between)), "\n")
    gone = F.aggregate(runs, F.lit(0), lambda total, run: total + run["stop"] - run["start"])
    return found.select(
        *[F.when(F.col(runs).isNull(), F.col(c)).otherwise(kept).alias(c) if c == text_col else F.col(c) for c in columns],
        F.when(F.col(text_col).isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"),
        F.coalesce(gone, F.lit(0)).cast("long").alias("n_removed"),
    )
