"""Mixing sources to target weights by Pareto order sampling.

Every source gets a word target.  Its documents are taken ``floor(target / size of source)``
times for certain; the rest of the target is an unequal-probability sample of fixed size in
words.  A document's inclusion probability is proportional to its size and stops at one; the
factor is solved so that the words expected equal the rest.  Documents that reach one have
a further certain copy.  The others are ranked by Pareto's order statistic, the odds of a
uniform number divided by the odds of inclusion, and the first ones that fill the rest are
taken.

The uniform number is a hash of id and seed, so a rerun takes the same documents; where rows
share an id, or have none, the rest of the row decides too.  The rank is cut without sorting
a source: word counts per rank bucket are summed first, and the one bucket per source that
holds the border is cut again, until it is small enough to be ordered row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zonepipe.llm.common import join_checked, unused, word_count, written

# A power of two, so that the borders of buckets within buckets are exact.
RANK_BUCKETS = 256
# A border bucket of at most so many rows is ordered in one task.
BORDER_ROWS = 4096
# Buckets are not cut below this width: ranks so near differ in little but rounding.
LEAST_WIDTH = 2.0**-48
# 13 hex digits of a digest: the 52 bits that a double holds exactly.
UNIFORM_DIGITS = 13


def uniform(id_col: str, seed: str, *more: Column) -> Column:
    """A number in (0, 1) that only the id, the seed and the values of ``more`` decide."""
    rest = [part for column in more for part in (F.lit("/"), column.cast("string"))]
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), *rest))
    drawn = F.conv(F.substring(digest, 1, UNIFORM_DIGITS), 16, 10).cast("double")
    return (drawn + F.lit(0.5)) / F.lit(float(16**UNIFORM_DIGITS))


def _drawn(df: DataFrame, id_col: str, seed: str, u: str, id_key: str) -> DataFrame:
    """``df`` plus its uniform numbers ``u`` and, for equal ranks, the order ``id_key``.

    Ids that occur once need nothing but themselves.  Rows that share an id, or are several
    without one, are told apart by a hash of the row, and full repeats by a count of them;
    which of the equal rows gets which number makes no difference.
    """
    shared, row, copy = unused(df, "shared_", "row_", "copy_")

    def by_id(rows: DataFrame) -> DataFrame:
        key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)))
        return rows.withColumn(u, uniform(id_col, seed)).withColumn(id_key, key)

    counted = df.groupBy(F.col(id_col).alias(shared)).agg(F.count("*").alias("n"))
    ids = written(counted.where("n > 1").select(shared), "mix-shared-ids")
    n_ids = ids.count()
    if not n_ids:
        return by_id(df)
    same = df[id_col].eqNullSafe(ids[shared])
    # Maps have no hash.
    hashed = [c for c, kind in df.dtypes if "map<" not in kind]
    equal = Window.partitionBy(id_col, row).orderBy(row)
    many = (
        join_checked(df, ids, same, "left_semi", n_ids)
        .withColumn(row, F.xxhash64(*hashed))
        .withColumn(copy, F.row_number().over(equal))
        .withColumn(u, uniform(id_col, seed, F.col(row), F.col(copy)))
        .withColumn(id_key, F.xxhash64(row, copy))
        .drop(row, copy)
    )
    return by_id(join_checked(df, ids, same, "left_anti", n_ids)).unionByName(many)


def source_targets(
    sizes: DataFrame, weights: Sequence[float], share: float, most: float
) -> DataFrame:
    """``source, source_size, target`` from one row per source with its size.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    ``share`` times all sizes.  No target exceeds ``most`` times the source's size; what is
    cut off goes to the others by weight, which is the level at which the capped sources
    and the level times weight of the others add up to the total.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(ordered) - 1) % len(weights)
    weighted = (
        sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (turn + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("reached", F.col("cap") / F.col("weight"))
    )
    everything = Window.partitionBy(F.lit(0))
    by_level = Window.orderBy("reached", F.col("source").asc_nulls_last())
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    levelled = weighted.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share))).withColumn(
        "level",
        (F.col("total") - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
        / F.sum("weight").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
    )
    # The first source, by level, whose cap lies above the level of those that remain; among
    # sources whose caps are reached together that is the one with the highest level.
    first = F.struct("reached", (-F.col("level")).alias("negative"))
    final = -F.min(F.when(F.col("reached") >= F.col("level"), first)).over(everything)["negative"]
    return levelled.select(
        "source", "source_size", F.coalesce(F.least("cap", final * F.col("weight")), F.col("cap")).alias("target")
    )


def inclusion_levels(sizes: DataFrame, plan: DataFrame, n_sources: int) -> DataFrame:
    """``source, level, full_above, full_words``: the factor from size to inclusion probability.

    ``sizes`` has one row per source and size, with its number ``n``; a source's
    probabilities ``min(1, level * size)`` add up, weighted by size, to the ``rest`` of
    ``plan``.  Sizes beyond ``full_above`` reach one and hold ``full_words``.  A source has
    fewer different sizes than the root of twice its words, which is what one task orders.
    """
    whole = F.col("n").cast("decimal(38,0)")
    one = F.col("size").cast("decimal(18,0)")
    found = join_checked(
        sizes.where("size > 0"),
        plan.select(F.col("source").alias("plan_source"), "rest"),
        F.col("source").eqNullSafe(F.col("plan_source")),
        "inner",
        n_sources,
    )
    by_size = Window.partitionBy("source").orderBy(F.col("size").desc())
    larger = by_size.rowsBetween(Window.unboundedPreceding, -1)
    others = by_size.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    words = (whole * one).cast("decimal(38,0)")
    levelled = (
        found.withColumn("words", words)
        .withColumn("squares", (words * one).cast("decimal(38,0)"))
        .withColumn("before", F.coalesce(F.sum("words").over(larger).cast("double"), F.lit(0.0)))
        .withColumn("level", (F.col("rest") - F.col("before")) / F.sum("squares").over(others).cast("double"))
    )
    # The largest size that stays below one, by the level at which all larger ones reach it.
    below = F.when(F.col("level") * F.col("size") < 1, F.struct("size", "level", "before"))
    return levelled.groupBy("source").agg(F.max(below).alias("first"), F.sum("words").alias("words")).select(
        "source",
        F.greatest(F.coalesce("first.level", F.lit(0.0)), F.lit(0.0)).alias("level"),
        F.coalesce("first.size", F.lit(0)).alias("full_above"),
        F.coalesce("first.before", F.col("words").cast("double")).alias("full_words"),
    )


def mix(
    df: DataFrame,
    weights: Sequence[float],
    share: float,
    most: float = 2.0,
    seed: str = "mix",
    id_col: str = "doc_id",
    source_col: str = "source",
    size: Column | None = None,
) -> DataFrame:
    """All rows of ``df`` plus ``size``, ``source_size``, ``target`` and ``copies``.

    ``size`` is a whole number, the words of ``text`` unless given.  ``copies`` is how often
    the mix takes a row: the certain copies, and one more where the sample holds it, which
    is the likelier the larger the row is.  Words taken of a source differ from its target
    by less than one document.  Null sources form one source; rows without words are taken
    as often as the source's certain copies, and in a source without words not at all.
    Rows that share an id, or have none, are drawn apart, full repeats too.  An empty table
    gives an empty result.  Columns of ``df`` with the names of result columns are replaced.

    ``most`` caps a target, so a row has at most ``most`` copies, rounded up.
    """
    size = word_count("text") if size is None else size
    results = ("size", "source_size", "target", "copies")
    columns = [c for c in df.columns if c not in results]
    u, id_key, key, plan_c, rank = unused(df, "u_", "id_", "source_key_", "plan_", "rank_")
    drawn = _drawn(df.withColumn("size", size), id_col, seed, u, id_key)
    narrow = written(drawn.select(F.col(source_col).alias(key), "size", u, id_key), "mix-sizes")
    counts = written(narrow.groupBy(F.col(key).alias("source"), "size").agg(F.count("*").alias("n")), "mix-counts")

    per_source = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = written(source_targets(per_source, weights, share, most), "mix-targets")
    n_sources = targets.count()
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    certain = targets.withColumn("certain", F.floor(ratio).cast("long")).withColumn(
        "rest", F.col("target") - F.col("certain") * F.col("source_size")
    )
    levels = inclusion_levels(counts, certain, n_sources).withColumnRenamed("source", "level_source")
    plan = written(
        certain.join(levels, F.col("source").eqNullSafe(F.col("level_source")), "left")
        .withColumn("rest", F.col("rest") - F.coalesce("full_words", F.lit(0.0)))
        .drop("level_source", "full_words"),
        "mix-levels",
    )

    def planned(rows: DataFrame, source: str, plan: DataFrame) -> DataFrame:
        """Rows with their source's plan as one column, and the rank of those left to chance."""
        right = plan.select(F.col("source").alias("plan_source"), F.struct(*plan.columns).alias(plan_c))
        found = join_checked(rows, right, rows[source].eqNullSafe(right["plan_source"]), "inner", n_sources)
        pi = F.col(plan_c)["level"] * F.col("size")
        q = F.col(u) / (1 - F.col(u)) * (1 - pi) / pi
        chance = (pi > 0) & (F.col("size") <= F.col(plan_c)["full_above"])
        return found.drop(right["plan_source"]).withColumn(rank, F.when(chance, q / (1 + q)))

    ranked = planned(narrow, key, plan).where(F.col(rank).isNotNull())
    last = _last_taken(ranked.select(F.col(key).alias("source"), "size", F.col(rank).alias("rank"), F.col(id_key).alias("id"), F.col(plan_c)["rest"].alias("rest")), n_sources)
    whole = written(
        plan.join(last, F.col("source").eqNullSafe(F.col("border_source")), "left").drop("border_source"), "mix-plan"
    )
    sampled = (F.col("size") > F.col(plan_c)["full_above"]) | (
        F.struct(F.col(rank), F.col(id_key)) <= F.col(plan_c)["last"]
    )
    more = F.when(F.col("size") > 0, F.coalesce(sampled.cast("long"), F.lit(0))).otherwise(F.lit(0))
    return planned(drawn, source_col, whole).select(
        *columns,
        "size",
        F.col(plan_c)["source_size"].alias("source_size"),
        F.col(plan_c)["target"].alias("target"),
        (F.col(plan_c)["certain"] + more).alias("copies"),
    )


def _last_taken(ranked: DataFrame, n_sources: int) -> DataFrame:
    """``border_source, last``: per source the rank and id up to which rows fill the rest.

    Each pass sums words per bucket and goes on with the rows of one bucket per source, a
    part in ``RANK_BUCKETS`` of those before; the passes end when no such bucket holds more
    than ``BORDER_ROWS`` rows.
    """
    low, width, before = F.lit(0.0), 1.0, F.lit(0.0)
    rows = ranked.select("*", low.alias("low"), before.alias("before"))
    while True:
        step = width / RANK_BUCKETS
        cut = F.least(F.floor((F.col("rank") - F.col("low")) / F.lit(step)), F.lit(RANK_BUCKETS - 1)).cast("int")
        rows = rows.withColumn("bucket", cut)
        by_rank = Window.partitionBy("source").orderBy("bucket")
        border = written(
            rows.groupBy("source", "bucket", "rest", "low", "before")
            .agg(F.sum("size").alias("words"), F.count("*").alias("n"))
            .withColumn("passed", F.col("before") + F.sum("words").over(by_rank) - F.col("words"))
            .where("passed <= rest")
            .groupBy("source")
            .agg(F.max(F.struct("bucket", "passed", "n", "low")).alias("border"))
            .select(
                F.col("source").alias("border_source"),
                F.col("border.bucket").alias("cut"),
                F.col("border.passed").alias("passed"),
                F.col("border.n").alias("n"),
                (F.col("border.low") + F.col("border.bucket") * F.lit(step)).alias("lower"),
            ),
            "mix-borders",
        )
        inside = (
            join_checked(rows, border, rows["source"].eqNullSafe(border["border_source"]), "inner", n_sources)
            .where("bucket = cut")
            .select("source", "size", "rank", "id", "rest", F.col("lower").alias("low"), F.col("passed").alias("before"))
        )
        width = step
        most = border.agg(F.max("n")).first()[0] or 0
        if most <= BORDER_ROWS or width < LEAST_WIDTH:
            break
        rows = written(inside, "mix-inside")
    in_order = Window.partitionBy("source").orderBy("rank", "id")
    nobody = F.struct(F.col("low").alias("rank"), F.lit(-(2**63)).alias("id"))
    return (
        inside.withColumn("middle", F.col("before") + F.sum("size").over(in_order) - F.col("size") / 2)
        .groupBy(F.col("source").alias("border_source"), "low")
        .agg(F.max(F.when(F.col("middle") <= F.col("rest"), F.struct("rank", "id"))).alias("last"))
        .select("border_source", F.coalesce("last", nobody).alias("last"))
    )
