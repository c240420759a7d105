"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Each text becomes a short vector of statistics.  Cosines of random projections of the
standardised vector approximate a Gaussian kernel; every partition adds up its share of
the normal equations, the summed system is solved on the driver (its size is the number
of features, not of documents), and the scores are made probabilities by an isotonic fit
to the label shares of fine score bins.  All labelled rows take part in every step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepipe.llm.common import written

FOURIER = 256
RIDGE = 1e-3
#: Kernel width in standard deviations of all statistics together.
WIDTH = 2.0
SEED = 17
BINS = 2048
#: Standardised statistics are held within so many standard deviations.
REACH = 8.0

STATISTICS = (
    "log_bytes", "log_words", "word_length", "upper", "digits", "stops", "shouts", "symbols", "bars",
    "blanks", "newlines", "non_ascii", "letters", "entropy", "distinct_words", "repeated_lines", "longest_line",
)


def byte_classes() -> np.ndarray:
    """A 0/1 matrix of byte values by the classes that ``statistics`` counts."""
    groups = (
        range(0x41, 0x5B),
        range(0x30, 0x3A),
        b".,;:'\"-()?",
        b"!",
        [b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) not in ".,;:'\"-()?!|"],
        b"|",
        b" \t\x0b\x0c\r",
        b"\n",
        range(0x80, 0x100),
        [b for b in range(0x80) if chr(b).isalpha()],
    )
    table = np.zeros((256, len(groups)))
    for k, values in enumerate(groups):
        table[list(values), k] = 1
    return table


def statistics(text: str | None, classes: np.ndarray) -> np.ndarray:
    """The vector of one whole text; a null text counts as empty."""
    data = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n, words = max(1, len(data)), data.split()
    shares = counts @ classes / n
    p = counts[counts > 0] / n
    lines = [line for line in data.split(b"\n") if line]
    return np.concatenate(
        (
            (np.log1p(len(data)), np.log1p(len(words)), np.log1p((len(data) - len(words)) / max(1, len(words)))),
            shares,
            (
                float(-(p * np.log2(p)).sum()),
                np.log1p(len(set(words))) / np.log1p(max(1, len(words))),
                1 - len(set(lines)) / max(1, len(lines)),
                np.log1p(max(map(len, lines), default=0)),
            ),
        )
    )


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def text_statistics(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    classes = byte_classes()
    for texts in batches:
        yield pd.Series([statistics(t if isinstance(t, str) else None, classes) for t in texts])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    #: Calibration: raw scores and the probabilities that belong to them.
    raw: np.ndarray
    probability: np.ndarray


def projection(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.normal(0, 1 / (WIDTH * np.sqrt(n)), (n, FOURIER)), rng.uniform(0, 2 * np.pi, FOURIER)


def kernel_features(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of statistics, with the standardised statistics and a constant."""
    z = np.clip((x - mean) / scale, -REACH, REACH)
    w, b = projection(x.shape[1])
    return np.hstack((np.sqrt(2 / FOURIER) * np.cos(z @ w + b), z, np.ones((len(x), 1))))


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Non-decreasing values nearest to ``value`` by weighted squares (pool adjacent violators)."""
    pools: list[list[float]] = []
    for v, w in zip(value, weight):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            (v1, w1, n1), (v2, w2, n2) = pools[-2:]
            pools[-2:] = [[(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]]
    return np.repeat([p[0] for p in pools], [int(p[2]) for p in pools])


def _partial_sums(mean: np.ndarray, scale: np.ndarray):
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                z = kernel_features(np.stack(batch["stats"]), mean, scale)
                own = np.hstack((z.T @ z, z.T @ batch["label"].to_numpy()[:, None]))
                total = own if total is None else total + own
        if total is not None:
            yield pd.DataFrame({"line": np.arange(len(total)), "cells": list(total)})

    return sums


def _added(part: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"line": part["line"].iloc[:1], "cells": [np.stack(part["cells"]).sum(axis=0)]})


def _predict_raw(mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
    @F.pandas_udf("double")
    def raw(stats: pd.Series) -> pd.Series:
        return pd.Series(kernel_features(np.stack(stats), mean, scale) @ weights if len(stats) else [], dtype=float)

    return raw


def train(labelled: DataFrame) -> Model | None:
    """The model of rows with ``stats`` and ``label`` (0 to 1); None without rows of both kinds."""
    n = len(STATISTICS)
    parts = [f(F.col("stats")[i]) for i in range(n) for f in (F.avg, F.stddev_pop)]
    seen = labelled.agg(F.count("*"), F.min("label"), F.max("label"), *parts).first()
    if not seen[0] or seen[1] == seen[2]:
        return None
    mean, scale = np.array(seen[3::2], float), np.array(seen[4::2], float)
    scale[scale < 1e-9] = 1
    width = FOURIER + n + 1
    summed = (
        labelled.mapInPandas(_partial_sums(mean, scale), "line int, cells array<double>")
        .groupBy("line")
        .applyInPandas(_added, "line int, cells array<double>")
    )
    # ``width`` rows, whatever the size of the corpus.
    system = np.stack([np.array(r["cells"]) for r in sorted(summed.collect(), key=lambda r: r["line"])])
    penalty = RIDGE * seen[0] * np.eye(width)
    penalty[-1, -1] = 0
    weights = np.linalg.solve(system[:, :width] + penalty, system[:, width])

    raw = _predict_raw(mean, scale, weights)(F.col("stats"))
    binned = labelled.select(raw.alias("raw"), "label").withColumn(
        "bin", F.floor(F.least(F.greatest((F.col("raw") + 0.5) / 2, F.lit(0.0)), F.lit(1.0)) * (BINS - 1))
    )
    bins = (
        binned.groupBy("bin").agg(F.avg("raw").alias("raw"), F.avg("label").alias("share"), F.count("*").alias("n")).orderBy("bin").collect()
    )
    at, share, n_rows = (np.array([r[k] for r in bins], float) for k in ("raw", "share", "n"))
    return Model(mean, scale, weights, at, isotonic(share, n_rows))


def probability(stats: Column, model: Model | None) -> Column:
    """Calibrated probability of label 1; 0.5 without a model."""
    if model is None:
        return F.lit(0.5)

    @F.pandas_udf("double")
    def calibrated(stats: pd.Series) -> pd.Series:
        if not len(stats):
            return pd.Series([], dtype=float)
        raw = kernel_features(np.stack(stats), model.mean, model.scale) @ model.weights
        return pd.Series(np.clip(np.interp(raw, model.raw, model.probability), 0, 1))

    return calibrated(stats)


def labelled_rows(stats: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """Statistics with the label of their id; rows that repeat an id in ``labels`` are averaged."""
    one = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("label_id"))
        .agg(F.avg(F.col(label_col).cast("double")).alias("label"))
    )
    return stats.join(one, stats[id_col] == one["label_id"]).select("stats", "label")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> tuple[Model | None, DataFrame]:
    """The model learned from labelled documents, and a table of every row's id and statistics.

    ``learn_from`` is a condition on the id that a row must meet to be learned from.  Null
    texts count as empty, rows with a null id are never learned from.  Columns of
    ``docs`` other than id and text are not looked at.
    """
    stats = written(docs.select(F.col(id_col), text_statistics(F.col(text_col)).alias("stats")), "statistics")
    known = stats if learn_from is None else stats.where(learn_from)
    return train(written(labelled_rows(known, labels, id_col, label_col), "labelled")), stats


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs``, unchanged, whose text scores ``threshold`` or more."""
    model, _ = fit(docs, labels, **options)
    text = F.col(options.get("text_col", "text"))
    return docs.where(probability(text_statistics(text), model) >= threshold)
