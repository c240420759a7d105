"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language in one pass over all training texts: every task
counts into a dense matrix and hands out its non-zero cells, which Spark sums.  The
log-probability matrix (languages by hash buckets) is the only thing that is sent to
executors; scoring gathers its cells for whole batches at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
#: Characters handled at once inside a task.
CHUNK = 1 << 19
#: The matrix takes at most so many bytes while it has LEAST_BUCKETS or more: 1,024 languages
#: have all BUCKETS, twice as many half of them, and so on.
MODEL_BYTES = 256 << 20
LEAST_BUCKETS = 1 << 10
#: Languages a task counts at once; their counts are handed out before it takes more.
COUNTED = 64

UNDETERMINED = "und"
SPACE = 32


@dataclass
class Model:
    languages: list[str]
    #: One row of log-probabilities per language, a power of two of buckets; the prior is apart.
    log_prob: np.ndarray
    log_prior: np.ndarray


def letter_table() -> np.ndarray:
    """Whether each code point of the basic plane is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(1 << 16)), bool, 1 << 16)


def _letters(codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    low = codes < len(letters)
    found = letters[np.where(low, codes, 0)] & low
    if not low.all():
        for code in np.unique(codes[~low]):
            if chr(code).isalpha():
                found |= codes == code
    return found


def grams(texts: list[str], letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per n-gram order: hash buckets and the text each belongs to, in text order.

    Letters are lower-cased, each run of other characters is one space; an n-gram lies
    inside one text, which has a space at either end.
    """
    padded = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(padded), dtype=np.int32), [len(p) for p in padded])
    is_letter = _letters(codes, letters)
    follows = np.concatenate(([False], ~is_letter[:-1] & (owner[1:] == owner[:-1])))
    keep = is_letter | ~follows
    codes, owner = np.where(is_letter, codes, SPACE)[keep].astype(np.uint32), owner[keep]
    rolled = np.zeros(len(codes), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        size = len(codes) - n + 1
        if size <= 0:
            return
        rolled = rolled[:size] * np.uint32(0x9E3779B1) + codes[n - 1 :]
        if n not in ORDERS:
            continue
        inside = owner[:size] == owner[n - 1 :]
        if n == 1:
            inside &= codes != SPACE
        mixed = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x85EBCA77) + np.uint32(n)
        yield ((mixed ^ (mixed >> np.uint32(13))) % np.uint32(BUCKETS))[inside], owner[:size][inside]


def chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of whole texts of about CHUNK characters, each with the position of its first."""
    start, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text)
        size += len(text)
        if size >= CHUNK:
            yield start, held
            start, held, size = i + 1, [], 0
    if held:
        yield start, held


def buckets_for(languages: int) -> int:
    """Buckets of a matrix of so many languages."""
    buckets = BUCKETS
    while buckets > LEAST_BUCKETS and languages * buckets * 8 > MODEL_BYTES:
        buckets //= 2
    return buckets


def _counted(counts: dict[str, np.ndarray], docs: dict[str, int]) -> Iterator[pd.DataFrame]:
    for language, total in counts.items():
        cells = np.flatnonzero(total)
        yield pd.DataFrame(
            {
                "lang": language,
                "bucket": np.concatenate(([-1], cells)),
                "n": np.concatenate(([docs[language]], total[cells])),
            }
        )


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    letters, counts, docs = letter_table(), {}, {}
    for batch in batches:
        for language, own in batch.groupby("lang", sort=True):
            if language not in counts and len(counts) >= COUNTED:
                yield from _counted(counts, docs)
                counts, docs = {}, {}
            total = counts.setdefault(language, np.zeros(BUCKETS, np.int64))
            docs[language] = docs.get(language, 0) + len(own)
            for _, texts in chunks(own["text"].tolist()):
                for bucket, _ in grams(texts, letters):
                    total += np.bincount(bucket, minlength=BUCKETS)
    yield from _counted(counts, docs)


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """The model of all rows with a text and a language; None if there are none.

    Any number of languages is learned.  Beyond 1,024 they share fewer buckets, and beyond
    32,768 the matrix grows with them, by 8 kB each.
    """
    rows = df.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    # One row for each language.
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not languages:
        return None
    buckets = buckets_for(len(languages))
    folded = F.when(F.col("bucket") < 0, F.col("bucket")).otherwise(F.col("bucket") % buckets)
    cells = rows.mapInPandas(_count, "lang string, bucket int, n long").groupBy("lang", folded.alias("bucket")).agg(F.sum("n").alias("n"))
    # As many cells as the matrix has, whatever the size of the corpus.
    found = cells.toArrow()
    at = {language: i for i, language in enumerate(languages)}
    row = np.fromiter((at[x] for x in found["lang"].to_pylist()), np.int64, found.num_rows)
    bucket, n = found["bucket"].to_numpy(), found["n"].to_numpy()
    counts, docs = np.zeros((len(languages), buckets)), np.zeros(len(languages))
    is_doc = bucket < 0
    docs[row[is_doc]] = n[is_doc]
    counts[row[~is_doc], bucket[~is_doc]] = n[~is_doc]
    smooth = counts + SMOOTHING
    return Model(languages, np.log(smooth / smooth.sum(axis=1, keepdims=True)), np.log(docs / docs.sum()))


def score(texts: list[str | None], model: Model, letters: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Best language of each text and its posterior probability."""
    sums, buckets = np.tile(model.log_prior, (len(texts), 1)), model.log_prob.shape[1]
    lettered = np.zeros(len(texts), bool)
    for start, part in chunks([t or "" for t in texts]):
        for order, (bucket, owner) in enumerate(grams(part, letters)):
            if not len(owner):
                continue
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            rows = start + owner[first]
            if order == 0:
                lettered[rows] = True
            bucket = bucket % np.uint32(buckets)
            for k in range(len(model.languages)):
                sums[rows, k] += np.add.reduceat(model.log_prob[k][bucket], first)
    best = sums.argmax(axis=1)
    top = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
    names = [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, lettered)]
    return names, np.where(lettered, top, 0.0)


def predict(df: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``df`` plus ``lang_pred`` and ``score``; only the text is looked at.

    Texts that are null or have no letter are ``und`` with score 0, and so is every text
    without a model.  Ties go to the language that sorts first.  Columns of ``df`` with
    these names are replaced.
    """
    df = df.drop("lang_pred", "score")
    if model is None:
        return df.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
    sent = df.sparkSession.sparkContext.broadcast((model.languages, model.log_prob, model.log_prior))

    @F.pandas_udf("lang_pred string, score double")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters, known = letter_table(), Model(*sent.value)
        for texts in batches:
            names, scores = score([t if isinstance(t, str) else None for t in texts], known, letters)
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    taken = "guess_"
    while taken in df.columns:
        taken = f"_{taken}"
    return df.withColumn(taken, guess(F.col(text_col))).select(
        *df.columns, F.col(taken)["lang_pred"].alias("lang_pred"), F.col(taken)["score"].alias("score")
    )
