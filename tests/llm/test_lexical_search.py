"""Ranked search against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonepipe.llm import lexical_search
from zonepipe.llm.lexical_search import LAST_ID, _Block, _search_block

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def plain_terms(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, top=20):
    counts = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    counts = [(doc_id, c, sum(c.values())) for doc_id, c in counts if c]
    n, total = len(counts), sum(c[2] for c in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    rows = []
    for item_id, text in items:
        asked = Counter(plain_terms(text))
        scored = []
        for doc_id, c, length in counts:
            m = 75 + 25 * length * n // total
            score = sum(
                k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, k in asked.items()
                if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        rows += [(item_id, r, None if no_id else d, -s) for r, (s, no_id, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(rows, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def pairs(df, id_col):
    return [tuple(r) for r in df.select(id_col, "text").collect()]


@pytest.mark.parametrize("block_rows", [4, 1 << 15])
def test_odd_rows(spark, odd, odd_wide, odd_dir, block_rows):
    items = spark.read.parquet(f"{odd_dir}/benchmark.parquet")
    expected = plain_search(pairs(odd, "doc_id"), pairs(items, "item_id"))
    assert expected
    for docs in (odd, odd_wide):
        clashing = items.select("*", F.lit(1).alias("rank"), F.lit(1).alias("doc_id"), F.lit(1).alias("score"))
        assert rows_of(lexical_search.search(docs, clashing, block_rows=block_rows)) == expected


def test_ties_repeats_long_items_and_item_blocks(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(90)] + ["the", "The", "ÉTÉ", "été", "x1"]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice((1, 5, 30, 200))))) for i in range(300)]
    docs += [(i, "the same words") for i in range(300, 360)] + [(5, "the same words"), (None, "the same words"), (361, ""), (362, None)]
    items = [(1, "the same words"), (1, "the same words"), (2, " ".join(words * 2)), (3, ""), (4, None), (5, "nothing of this"), (None, "w1, W1 w2")]
    items += [(10 + i, " ".join(rng.choices(words, k=4))) for i in range(20)]
    expected = plain_search(docs, items)
    rng.shuffle(docs)
    tables = spark.createDataFrame(docs, "doc_id long, text string").repartition(7), spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(lexical_search.search(*tables, block_rows=16)) == expected
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 10)
    assert rows_of(lexical_search.search(*tables)) == expected
    assert rows_of(lexical_search.search(*tables, top=3)) == plain_search(docs, items, top=3)


def test_masks_are_skipped_once_the_last_place_is_safe(monkeypatch):
    """Documents with both terms fill all places: those with one term are never scored."""
    n = 4000
    both = np.arange(n) < 600
    sizes = np.where(both, 2, 1)
    terms = np.concatenate([[0, 1] if b else [i % 2] for i, b in enumerate(both)]).astype(np.int32)
    block = _Block(np.arange(n), np.full(n, 10), sizes, terms, np.ones(len(terms), np.int64), n, 10 * n)
    docs, starts, ends, bounds = block.groups([0, 1], [5, 7])
    assert len(bounds) == 3 and sorted(docs) == list(range(n)) and list(bounds) == sorted(bounds, reverse=True)
    assert sorted(docs[starts[0] : ends[0]]) == list(range(600))
    scored = []
    whole = _Block.scores
    monkeypatch.setattr(_Block, "scores", lambda self, docs, *a: scored.extend(docs) or whole(self, docs, *a))
    nothing = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    ids, _ = _search_block(block, ([0, 1], [5, 7]), nothing, 20)
    assert list(ids) == list(range(20))
    assert sorted(scored) == list(range(600))


def test_masks_of_more_terms_than_a_word_holds():
    rng = np.random.default_rng(1)
    present = rng.random((50, 150)) < 0.02
    docs, terms = np.nonzero(present)
    block = _Block(np.arange(50), np.full(50, 10), present.sum(1), terms.astype(np.int32), np.ones(len(terms), np.int64), 50, 500)
    known = [t for t in range(150) if t in block.docs]
    order, starts, ends, bounds = block.groups(known, [1] * len(known))
    groups = {}
    for d in range(50):
        if present[d].any():
            groups.setdefault(tuple(present[d]), []).append(d)
    assert sorted(sorted(order[a:b].tolist()) for a, b in zip(starts, ends)) == sorted(groups.values())
    for a, b, bound in zip(starts, ends, bounds):
        assert bound == sum(block.most[t] for t in np.flatnonzero(present[order[a]]))


def test_without_documents_or_items(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    no_docs, no_items = docs.limit(0), spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert rows_of(lexical_search.search(no_docs, items)) == rows_of(lexical_search.search(docs, no_items)) == []
    assert rows_of(lexical_search.search(docs, items))[0][:3] == (1, 1, 1)
    assert LAST_ID == 2**63 - 1
