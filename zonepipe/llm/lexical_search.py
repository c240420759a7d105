"""Ranked lexical search by presence-mask grouping.

Every document is read once and becomes its length and its counts of query terms.  Of a
block of these rows every term has a bitmap.  For an item, the bitmaps of its terms are
turned into a mask per document, which tells the terms it matches, and documents with equal
masks form a group.  A mask bounds the score of its group, as each term adds at most what
it adds to any document of the block.  Groups are scored by descending bound, and an item is
finished with a block once its last place is above every bound that is left.

A task keeps the best documents of its blocks for each item, so what is shuffled does not
grow with matches: a term that is in every document makes no pairs.  Items are queries in
blocks of bounded size, one after the other; a block's terms are all that is sent to tasks.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonepipe.llm.common import written

TOP = 20
#: Term occurrences of items that are searched together, and items: some 50 MB in a worker.
#: An item is never split.
BLOCK_TERMS = 100_000
BLOCK_ITEMS = 20_000
#: Documents, and counts of query terms in them, that are searched together.
BLOCK_ROWS = 1 << 15
BLOCK_COUNTS = 1 << 21
#: Terms of one word of a mask.
WORD_BITS = 64
#: Documents that are scored together, at least.
SCORED = 256
#: Tasks' best documents are united in so many parts of an item before one ranks them.
PARTS = 64

# Weights of the score, and the bytes of terms: 0-9, a-z after lower-casing, 0x80 and above.
SCALE, PLAIN, BY_LENGTH, DAMP = 1_000_000_000, 75, 25, 12
_TERM_BYTES = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
_FOLD = bytes(low if (low := b + 32 if 0x41 <= b <= 0x5A else b) in _TERM_BYTES else 0x20 for b in range(256))

COUNTS = "doc_id long, n long, terms array<int>, tfs array<long>"
BEST = "item int, doc_id long, score long"


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of term characters, A-Z lower-cased; none for null."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _counter(vocabulary: dict[bytes, int]):
    """Length and counts of query terms of each document that has a term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lengths, terms, tfs = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = terms_of(text.as_py())
                if own:
                    known = sorted((vocabulary[t], tf) for t, tf in Counter(own).items() if t in vocabulary)
                    ids.append(doc_id)
                    lengths.append(len(own))
                    terms.append([t for t, _ in known])
                    tfs.append([tf for _, tf in known])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())),
                    pa.array(tfs, pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    return count


class _Block:
    """Documents as lists and bitmaps of each term, with what each term adds to each document for one unit of weight."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, n: int, total: int):
        self.ids, self.rows = ids, len(lengths)
        damp = DAMP * (PLAIN + BY_LENGTH * lengths * n // total)
        docs = np.repeat(np.arange(self.rows), sizes)
        order = np.argsort(terms, kind="stable")
        docs, terms, tfs = docs[order], terms[order], tfs[order]
        adds = SCALE * tfs // (1000 * tfs + damp[docs])
        known, first = np.unique(terms, return_index=True)
        last = np.append(first[1:], len(terms))
        self.docs = {int(t): docs[a:b] for t, a, b in zip(known, first, last)}
        self.adds = {int(t): adds[a:b] for t, a, b in zip(known, first, last)}
        self.most = {int(t): int(adds[a:b].max()) for t, a, b in zip(known, first, last)}

    def bitmap(self, term: int) -> np.ndarray:
        present = np.zeros(self.rows, bool)
        present[self.docs[term]] = True
        return np.packbits(present)

    def groups(self, terms: list[int], weights: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Documents with a term, ordered by mask; where masks begin and end; their bounds, in descending order."""
        matched = np.zeros(-(-self.rows // 8), np.uint8)
        for t in terms:
            matched |= self.bitmap(t)
        docs = np.flatnonzero(np.unpackbits(matched, count=self.rows))
        group, bounds = np.zeros(len(docs), np.int64), np.zeros(1, np.int64)
        for at in range(0, len(terms), WORD_BITS):
            some = terms[at : at + WORD_BITS]
            present = np.stack([np.unpackbits(self.bitmap(t), count=self.rows)[docs] for t in some])
            masks = np.zeros((len(docs), WORD_BITS // 8), np.uint8)
            packed = np.packbits(present, axis=0, bitorder="little").T
            masks[:, : packed.shape[1]] = packed
            words, word = np.unique(masks.view("<u8")[:, 0], return_inverse=True)
            pairs, group = np.unique(group * len(words) + word, return_inverse=True)
            bits = np.unpackbits(words.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, : len(some)]
            most = np.array([w * self.most[t] for t, w in zip(some, weights[at:])], np.int64)
            bounds = bounds[pairs // len(words)] + (bits.astype(np.int64) @ most)[pairs % len(words)]
        by_bound = np.argsort(-bounds, kind="stable")
        place = np.empty(len(bounds), np.int64)
        place[by_bound] = np.arange(len(bounds))
        order = np.argsort(place[group], kind="stable")
        ends = np.cumsum(np.bincount(place[group], minlength=len(bounds)))
        return docs[order], np.append(0, ends[:-1]), ends, bounds[by_bound]

    def scores(self, docs: np.ndarray, terms: list[int], weights: list[int]) -> np.ndarray:
        total = np.zeros(len(docs), np.int64)
        for t, w in zip(terms, weights):
            holders = self.docs[t]
            at = np.minimum(np.searchsorted(holders, docs), len(holders) - 1)
            total += np.where(holders[at] == docs, w * self.adds[t][at], 0)
        return total


#: Ids of documents without an id; they come last among equal scores.
LAST_ID = (1 << 63) - 1


def _top(ids: np.ndarray, scores: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:top]
    return ids[order], scores[order]


def _search_block(block: _Block, item: tuple[list[int], list[int]], best: tuple, top: int) -> tuple:
    """The best documents so far and of the block, by descending score and ascending id."""
    pairs = [(t, w) for t, w in zip(*item) if w and t in block.docs]
    if not pairs:
        return best
    terms, weights = [t for t, _ in pairs], [w for _, w in pairs]
    docs, starts, ends, bounds = block.groups(terms, weights)
    ids, scores = best
    k = 0
    while k < len(bounds):
        # A document that only equals the last place may still have the smaller id.
        if len(scores) == top and bounds[k] < scores[-1]:
            break
        after = max(k + 1, int(np.searchsorted(ends, starts[k] + SCORED)))
        some = docs[starts[k] : ends[after - 1]]
        ids, scores = _top(
            np.concatenate((ids, block.ids[some])), np.concatenate((scores, block.scores(some, terms, weights))), top
        )
        k = after
    return ids, scores


def _searcher(items: list[tuple[list[int], list[int]]], n: int, total: int, top: int, block_rows: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(items)
        held: list[tuple[np.ndarray, ...]] = []
        rows = counts = 0

        def finish() -> None:
            block = _Block(*[np.concatenate(c) for c in zip(*held)], n, total)
            for i, item in enumerate(items):
                best[i] = _search_block(block, item, best[i], top)

        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                ids = part.column(0).fill_null(LAST_ID).to_numpy()
                lists = [part.column(c).flatten().to_numpy() for c in (2, 3)]
                sizes = np.diff(part.column(2).offsets.to_numpy())
                held.append((ids, part.column(1).to_numpy(), sizes, *lists))
                rows, counts = rows + len(ids), counts + len(lists[0])
                if rows >= block_rows or counts >= BLOCK_COUNTS:
                    finish()
                    held, rows, counts = [], 0, 0
        if held:
            finish()
        numbers = np.repeat(np.arange(len(items), dtype=np.int32), [len(b[0]) for b in best])
        ids, scores = (np.concatenate([b[k] for b in best]) for k in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers), pa.array(ids, mask=ids == LAST_ID), pa.array(scores)], ["item", "doc_id", "score"]
        )

    return search


def _item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items with their terms, in blocks; the driver holds one block at a time."""
    block, n_terms = [], 0
    for item_id, text in items.toLocalIterator():
        terms = terms_of(text)
        if not terms:
            continue
        if block and (n_terms + len(terms) > BLOCK_TERMS or len(block) >= BLOCK_ITEMS):
            yield block
            block, n_terms = [], 0
        block.append((item_id, terms))
        n_terms += len(terms)
    if block:
        yield block


def _ranked(found: DataFrame, top: int) -> DataFrame:
    """Ranks of each item, over parts first: no task ranks more than PARTS times the places of an item."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    parts = found.withColumn("part", F.spark_partition_id() % PARTS)
    some = parts.withColumn("place", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("place") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).select("item", "rank", "doc_id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item with a score above 0.

    Equal scores are ranked by ascending id, documents without an id last; rows that repeat
    an id are documents of their own, and rows that repeat an item are searched one by one.
    Null and empty texts have no terms; they match nothing and are not counted.  Other
    columns are not looked at.  ``block_rows`` does not change the result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    queries = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
    result = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for number, block in enumerate(_item_blocks(queries.orderBy("item_id", "text"))):
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in block for t in terms}))}
        counted = written(texts.mapInArrow(_counter(vocabulary), COUNTS), "counts")
        n, total = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n:
            break
        holders = dict(counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
        weight = {
            t: math.floor(1000 * math.log((2 * n + 2) / (2 * holders.get(i, 0) + 1))) for t, i in vocabulary.items()
        }
        asked = []
        for _, terms in block:
            times = Counter(terms)
            asked.append(([vocabulary[t] for t in times], [weight[t] * k for t, k in times.items()]))
        best = counted.mapInArrow(_searcher(asked, n, total, top, block_rows), BEST)
        ids = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], "item int, item_id long")
        named = written(_ranked(best, top), "ranked").join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")
        result = named if number == 0 else result.unionByName(named)
    return result
