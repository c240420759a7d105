"""Quality rules: a decision list learned by sequential covering.

Statistics of every text are built-in expressions.  From labelled rows a list of rules is
learned that name texts of low quality: a rule is grown, condition by condition, on two
thirds of the rows by information gain, pruned on the other third to the leading
conditions that hold best there, and the rows it covers are put aside before the next.
A rule that is not precise on both parts is dropped, and no further one begins with its first
statistic; learning ends when none is left to begin with.  The list becomes one ordered
conditional expression: the first rule that holds rejects a text, and a text that none
rejects is kept.

Every step of learning is one aggregate over the labelled rows, by statistic and step of a
logarithmic scale; a few hundred rows reach the driver, whatever the number of texts.
Steps are exact counts, so the list does not depend on how rows are partitioned.

Repeated three-word windows are found inside a row, without a shuffle: hashes with their
position in the low bits are sorted as plain numbers, and neighbours with equal hashes are
compared word by word.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepipe.llm.common import WHITESPACE, text_or_empty, written

WINDOW = 3
#: Characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"
MAX_RULES = 12
MAX_CONDITIONS = 3
#: Share of low quality that a rule must reach among the rows it covers: on each part of the
#: labelled rows, and on both together with one row of high quality more, so that a rule on a
#: handful of rows does not count.
PRECISION = 0.9
#: Steps of a doubling that thresholds are searched on, and the values below which all are one step.
STEPS = 8
SMALLEST = 1 / 1024

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATISTICS = (
    "words", "word_length", "symbols_per_word", "marks_per_word", "stops_per_word", "capitals_per_word", "digits_per_word",
    "distinct_words", "repeated_words", "repeated_lines", "words_per_line",
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text, which has to be non-null."""
    trimmed = F.btrim(text, F.lit(WHITESPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def _repeated_words(words: Column, n: Column) -> Column:
    """Words inside windows that occur twice or more, first occurrences included."""

    def window(i: Column) -> list[Column]:
        return [F.get(words, i + k) for k in range(WINDOW)]

    def found(low: Column) -> Column:
        # ``low`` covers the bits of a position; the hash keeps the others.
        marked = F.transform(
            F.sequence(F.lit(0), n - WINDOW),
            lambda i: F.xxhash64(*window(i)).bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long")),
        )
        return let(F.sort_array(marked), lambda ordered: covered(low, ordered))

    def covered(low: Column, ordered: Column) -> Column:
        def same(x: Column, y: Column) -> Column:
            i, j = (v.bitwiseAND(low).cast("int") for v in (x, y))
            alike = x.bitwiseXOR(y) <= low
            return F.coalesce(
                alike & (x.bitwiseXOR(y) >= 0) & reduce(lambda a, b: a & b, [p == q for p, q in zip(window(i), window(j))]), F.lit(False)
            )

        repeats = F.filter(ordered, lambda x, k: same(x, F.get(ordered, k - 1)) | same(x, F.get(ordered, k + 1)))
        starts = F.sort_array(F.transform(repeats, lambda x: x.bitwiseAND(low)))
        return let(starts, lengths)

    def lengths(starts: Column) -> Column:
        own = F.transform(starts, lambda at, k: F.least(F.lit(WINDOW).cast("long"), F.get(starts, k + 1) - at))
        return F.aggregate(own, F.lit(0).cast("long"), lambda a, b: a + b)

    bits = F.length(F.bin(n.cast("long")))
    enough = let(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1, found)
    return F.when(n < WINDOW, F.lit(0).cast("long")).otherwise(enough)


def statistics(text: str | Column) -> Column:
    """A struct of the counts in ``BASE`` and the ratios in ``STATISTICS`` of a whole text.

    A null text counts as empty; ratios over nothing are 0.
    """

    def ratio(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part.cast("double") / whole).otherwise(0.0)

    def counts(text: Column, words: Column, lines: Column) -> Column:
        n = F.size(words)
        blanks = F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))
        return F.struct(
            n.cast("long").alias("n_words"),
            (F.length(text) - blanks).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeated_words(words, n).alias("n_repeat_words"),
            F.size(lines).alias("lines"),
            F.size(F.array_distinct(words)).alias("distinct"),
            F.regexp_count(text, F.lit("[!?]")).alias("marks"),
            F.regexp_count(text, F.lit("[.,;:]")).alias("stops"),
            F.regexp_count(text, F.lit(r"\p{Lu}")).alias("capitals"),
            F.regexp_count(text, F.lit("[0-9]")).alias("digits"),
        )

    def ratios(c: Column) -> Column:
        n = c["n_words"]
        return F.struct(
            *[c[b].alias(b) for b in BASE],
            n.cast("double").alias("words"),
            ratio(c["word_chars"], n).alias("word_length"),
            ratio(c["n_symbols"], n).alias("symbols_per_word"),
            ratio(c["marks"], n).alias("marks_per_word"),
            ratio(c["stops"], n).alias("stops_per_word"),
            ratio(c["capitals"], n).alias("capitals_per_word"),
            ratio(c["digits"], n).alias("digits_per_word"),
            ratio(c["distinct"], n).alias("distinct_words"),
            ratio(c["n_repeat_words"], n).alias("repeated_words"),
            ratio(c["n_dup_lines"], c["lines"]).alias("repeated_lines"),
            ratio(n, c["lines"]).alias("words_per_line"),
        )

    whole = text_or_empty(text)
    lines = F.filter(F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(WHITESPACE)) != "")
    parts = F.struct(whole.alias("text"), words_of(whole).alias("words"), lines.alias("lines"))
    return let(let(parts, lambda p: counts(p["text"], p["words"], p["lines"])), ratios)


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def holds(self, of: Column) -> Column:
        value = of[self.statistic]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    """Conditions that hold together for texts of low quality, and the labelled rows they cover."""

    conditions: tuple[Condition, ...]
    low: float = 0.0
    high: float = 0.0

    def holds(self, of: Column) -> Column:
        return reduce(lambda a, b: a & b, [c.holds(of) for c in self.conditions])

    def __str__(self) -> str:
        return f"reject if {' and '.join(map(str, self.conditions))} ({self.low:g} of {self.low + self.high:g} labelled rows)"


def verdict(rules: Sequence[Rule], stats: Column) -> Column:
    """False for texts the list rejects: one conditional expression, rule after rule."""
    kept = F.lit(True)
    for rule in reversed(rules):
        kept = F.when(rule.holds(stats), F.lit(False)).otherwise(kept)
    return kept


def _steps(rows: DataFrame) -> dict[str, list[tuple]]:
    """Per statistic and step of the scale, in order: smallest and largest value, low and high rows."""
    step = F.floor(F.log2(F.col("value") + SMALLEST) * STEPS)
    counted = (
        rows.select(
            F.explode(F.array(*[F.struct(F.lit(s).alias("statistic"), F.col("stats")[s].alias("value")) for s in STATISTICS])).alias("one"),
            "label",
        )
        .select("one.statistic", "one.value", "label")
        .groupBy("statistic", step.alias("step"))
        .agg(F.min("value"), F.max("value"), F.sum(1 - F.col("label")), F.sum("label"))
        .collect()
    )
    found: dict[str, list[tuple]] = {s: [] for s in STATISTICS}
    for statistic, _, *figures in sorted(counted, key=lambda r: r[:2]):
        found[statistic].append(tuple(figures))
    return found


def _gain(low: float, high: float, all_low: float, all_high: float) -> float:
    """Information gained on the low rows that a further condition leaves."""
    if not low:
        return 0.0
    return low * (math.log2(low / (low + high)) - math.log2(all_low / (all_low + all_high)))


def _best(steps: dict[str, list[tuple]], without: set[str]) -> Condition | None:
    """The condition with the highest gain; ties go to the earlier statistic and smaller threshold."""
    best, most = None, 1e-9
    for statistic, bins in steps.items():
        if statistic in without:
            continue
        all_low, all_high = sum(b[2] for b in bins), sum(b[3] for b in bins)
        low = high = 0.0
        for (_, top, l, h), (bottom, *_) in zip(bins, bins[1:]):
            low, high = low + l, high + h
            threshold = (top + bottom) / 2
            for above, gain in (
                (False, _gain(low, high, all_low, all_high)),
                (True, _gain(all_low - low, all_high - high, all_low, all_high)),
            ):
                if gain > most:
                    best, most = Condition(statistic, above, threshold), gain
    return best


def _grown(rows: DataFrame, without: set[str]) -> list[Condition]:
    """Conditions added one by one, until only low rows are left or none gains anything.

    The first is not on a statistic in ``without``.
    """
    conditions: list[Condition] = []
    while len(conditions) < MAX_CONDITIONS:
        steps = _steps(rows)
        some = next(iter(steps.values()))
        if not sum(b[2] for b in some) or not sum(b[3] for b in some):
            break
        best = _best(steps, set() if conditions else without)
        if best is None:
            break
        conditions.append(best)
        rows = rows.where(best.holds(F.col("stats")))
    return conditions


def _pruned(rows: DataFrame, conditions: list[Condition], precision: float) -> Rule | None:
    """The leading conditions that tell low from high rows best among those not grown from."""
    rules = [Rule(tuple(conditions[: i + 1])) for i in range(len(conditions))]
    sums = [
        F.coalesce(F.sum(F.when(rule.holds(F.col("stats")) & F.col("grow").eqNullSafe(grow), value)), F.lit(0.0))
        for rule in rules
        for grow in (True, False)
        for value in (1 - F.col("label"), F.col("label"))
    ]
    figures = list(rows.agg(*sums).first())
    best, most = None, -1.0
    for i, rule in enumerate(rules):
        grow_low, grow_high, low, high = figures[4 * i : 4 * i + 4]
        parts = ((low, high), (grow_low, grow_high), (low + grow_low, high + grow_high + 1))
        if not low or any(part[0] < precision * sum(part) for part in parts):
            continue
        if (worth := (low - high) / (low + high)) > most:
            best, most = Rule(rule.conditions, grow_low + low, grow_high + high), worth
    return best


def learn(labelled: DataFrame, max_rules: int = MAX_RULES, precision: float = PRECISION) -> list[Rule]:
    """The decision list of rows with ``stats``, ``label`` (0 low to 1 high) and ``grow``.

    ``grow`` tells rows that rules are grown on from those they are pruned on.  Without rows
    of both kinds, or when nothing tells them apart, the list is empty and keeps all.
    """
    rules: list[Rule] = []
    misled: set[str] = set()
    while len(rules) < max_rules:
        left = labelled.where(verdict(rules, F.col("stats")))
        conditions = _grown(left.where("grow"), misled)
        if not conditions:
            break
        rule = _pruned(left, conditions, precision)
        if rule is None:
            misled.add(conditions[0].statistic)
        else:
            rules.append(rule)
    return rules


def labelled_rows(stats: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """Statistics with the label of their id; an id that ``labels`` repeats has its mean label.

    Two thirds of the ids are to grow rules on.  Rows without an id or a label take no part.
    """
    one = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("label_id"))
        .agg(F.avg(F.col(label_col).cast("double")).alias("label"))
    )
    found = stats.select(F.col(id_col).alias("doc"), "stats").join(one, F.col("doc") == F.col("label_id"))
    return found.select("stats", "label", (F.pmod(F.xxhash64("doc"), F.lit(3)) != 0).alias("grow"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    **options,
) -> tuple[list[Rule], DataFrame]:
    """The decision list learned from all labelled documents, and a table of every row's id and ``stats``.

    Statistics meet labels; texts are not moved.  Other columns are not looked at.
    """
    stats = written(docs.select(F.col(id_col), statistics(text_col).alias("stats")), "statistics")
    return learn(written(labelled_rows(stats, labels, id_col, label_col), "labelled"), **options), stats


def judged(docs: DataFrame, rules: Sequence[Rule], text_col: str = "text", into: str = "stats", kept: str = "kept") -> DataFrame:
    """``docs`` with the struct ``into`` of statistics and the verdict ``kept``; columns so named are replaced."""
    rows = docs.drop(into, kept).withColumn(into, statistics(text_col))
    return rows.withColumn(kept, verdict(rules, F.col(into)))


def accepted(docs: DataFrame, labels: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, unchanged, that the list learned from ``labels`` keeps.

    Null and empty texts are judged by their statistics, which are all 0.
    """
    rules, _ = fit(docs, labels, text_col=text_col, **options)
    return docs.where(let(statistics(text_col), lambda stats: verdict(rules, stats)))
