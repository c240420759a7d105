"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark items and documents are normalised alike: A-Z lower-cased, everything that is
not part of a word turned into one space.  A window of consecutive item words is one
pattern, bounded by spaces so that it matches whole words only.  Each document is scanned
once against all patterns; word positions and, on request, byte offsets in the original
text come back.

An automaton takes memory in proportion to its patterns, so at most ``max_bytes`` of them
go into one.  Where the benchmark has more, a worker holds back a bounded number of texts,
scans them with one automaton after the other and unites the hits: there is one Python node
and one automaton at a time, and the result does not depend on their number.  The text of
the benchmark itself goes to the driver and to every worker.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import islice

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepipe.llm.common import unused

WINDOW = 10
# Bytes of windows in one automaton, which has no more nodes than that: a few hundred MB.
MAX_BYTES = 4_000_000
# Characters of text that are scanned with one automaton before the next one is built.
HELD_CHARACTERS = 32_000_000

# Bytes of words are 0-9, a-z after lower-casing, and all of 0x80 and above.
_WORD_BYTES = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
_FOLD = bytes(
    low if (low := (b + 32 if 0x41 <= b <= 0x5A else b)) in _WORD_BYTES else 0x20 for b in range(256)
)

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
HIT_SCHEMA = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(SPAN)),
    ]
)


def folded(text: str | None) -> bytes:
    """The text's UTF-8 bytes, lower-cased, with a space for each byte outside words.

    Offsets stay those of the original text.
    """
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)


def patterns(items: Iterable[tuple[str, str]], window: int = WINDOW) -> dict[bytes, list[str]]:
    """Windows of the items' words, each with the ids of the items that hold it."""
    return next(pattern_parts(items, window, math.inf), {})


def pattern_parts(items: Iterable[tuple[str, str]], window: int, max_bytes: float) -> Iterator[dict[bytes, list[str]]]:
    """The windows in parts of at most ``max_bytes``, or one window where that is longer.

    A window that several items hold may come in several parts.
    """
    found: dict[bytes, set[str]] = {}
    size = 0
    for item, text in items:
        words = folded(text).split()
        for i in range(max(1, len(words) - window + 1) if words else 0):
            pattern = b" " + b" ".join(words[i : i + window]) + b" "
            if pattern not in found:
                if found and size + len(pattern) > max_bytes:
                    yield {k: sorted(v) for k, v in found.items()}
                    found, size = {}, 0
                found[pattern] = set()
                size += len(pattern)
            found[pattern].add(item)
    if found:
        yield {k: sorted(v) for k, v in found.items()}


def automaton(windows: dict[bytes, list[str]]) -> ahocorasick.Automaton:
    """Latin-1 characters stand for bytes, so positions are byte positions."""
    built = ahocorasick.Automaton()
    for pattern, items in windows.items():
        built.add_word(pattern.decode("latin-1"), (len(pattern), items))
    if windows:
        built.make_automaton()
    return built


def scan(text: str | None, built: ahocorasick.Automaton) -> tuple[list[tuple[int, int]], set[str]]:
    """Ranges of words that patterns cover, end excluded, and the items the patterns belong to."""
    words = folded(text).split()
    if not words or not len(built):
        return [], set()
    joined = b" " + b" ".join(words) + b" "
    hits, items = [], set()
    for end, (length, owners) in built.iter(joined.decode("latin-1")):
        hits.append((end - length + 1, end))
        items.update(owners)
    if not hits:
        return [], items
    # The n-th space of the joined text stands before word n.
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
    first, last = np.searchsorted(spaces, np.array(hits).T)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, last, -1)
    return _runs(np.cumsum(edge[:-1]) > 0), items


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Where maximal runs of set flags start, and where they have ended."""
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def result(text: str | None, ranges: list[tuple[int, int]], items: set[str], spans: bool) -> tuple:
    """``(words, hit words, items, byte spans)`` of one text from the word ranges that are hit."""
    flat = folded(text)
    n = len(flat.split())
    if not ranges:
        return n, 0, sorted(items), []
    hit = np.zeros(n, bool)
    for start, stop in ranges:
        hit[start:stop] = True
    found = []
    if spans:
        words = _runs(np.frombuffer(flat, np.uint8) != 0x20)
        found = [{"start": words[a][0], "stop": words[b - 1][1]} for a, b in _runs(hit)]
    return n, int(hit.sum()), sorted(items), found


def _held(batches: Iterator[pd.Series], characters: float) -> Iterator[list[list[str | None]]]:
    """Batches of texts in groups that reach ``characters`` or end with the input."""
    group, size = [], 0
    for batch in batches:
        texts = [t if isinstance(t, str) else None for t in batch]
        group.append(texts)
        size += sum(len(t) for t in texts if t)
        if size >= characters:
            yield group
            group, size = [], 0
    if group:
        yield group


def _scanner(items: list[tuple[str, str]], window: int, spans: bool, max_bytes: int):
    """A scalar Pandas UDF; a single automaton is built once by each worker, several in turn."""

    @F.pandas_udf(HIT_SCHEMA)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parts = list(islice(pattern_parts(items, window, max_bytes), 2))
        single = automaton(parts[0] if parts else {}) if len(parts) < 2 else None
        del parts
        for group in _held(batches, 0 if single is not None else HELD_CHARACTERS):
            texts = [t for batch in group for t in batch]
            ranges, owners = [[] for _ in texts], [set() for _ in texts]
            several = map(automaton, pattern_parts(items, window, max_bytes))
            for built in [single] if single is not None else several:
                for i, text in enumerate(texts):
                    covered, found = scan(text, built)
                    ranges[i] += covered
                    owners[i] |= found
            rows = iter([result(t, r, o, spans) for t, r, o in zip(texts, ranges, owners)])
            for batch in group:
                yield pd.DataFrame(list(islice(rows, len(batch))), columns=["n_words", "n_hit", "items", "spans"])

    return find


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    spans: bool = True,
    max_bytes: int = MAX_BYTES,
    into: str = "hits",
) -> DataFrame:
    """``docs`` with a struct ``into``: words, hit words, items and byte spans of the original.

    A span runs from the first to the last hit word of a maximal run.  An item with fewer
    words than a window is one window; items and documents without words, null texts
    included, match nothing.  A null item id counts as the text ``null``.  Items with equal
    windows are all named.  With an empty benchmark nothing is hit.  ``docs`` may hold any
    other columns; one named like ``into`` is replaced.
    """
    rows = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
        F.coalesce(item_text_col, F.lit("")).alias("text"),
    )
    items = [(r["item"], r["text"]) for r in rows.collect()]
    return docs.drop(into).withColumn(into, _scanner(items, window, spans, max_bytes)(F.col(text_col)))


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, unchanged, that hold no window of the benchmark."""
    (hits,) = unused(docs, "hits")
    found = find_contamination(docs, benchmark, spans=False, into=hits, **options)
    return found.where(F.col(hits)["n_hit"] == 0).select(*docs.columns)
