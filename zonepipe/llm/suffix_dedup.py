"""Removal of byte strings that also occur in an earlier document, by sorted suffixes.

A byte goes when a 50-byte string over it also starts in a document with a smaller id.
Most positions cannot take part, so suffixes are sorted only where it matters:

1. Anchors.  A 20-byte gram is an anchor where its hash is the least of some 31 in a row,
   so every 50-byte string holds an anchor, and equal strings hold it at the same place.
   An anchor's context is the 80 bytes in which all 50-byte strings over its gram lie,
   known by a 64-bit hash beside 32 bits of its gram's.
   Documents are dealt into batches by hash; a batch sends hashes of its distinct grams
   and contexts, never text, to gram shards.
2. A shard answers each batch: a context that occurs in an earlier document is covered
   as a whole; a gram with several contexts needs a look at the bytes, and only the
   first document of each context has to send them.
3. Those contexts are sorted by deep-shallow sorting: multikey quicksort (eight bytes as
   one character) to a shallow depth, then a blind trie for each group whose suffixes
   still agree.  Equal strings that an earlier document holds are covered.
4. Every document is cut once by all of its spans.

Batches live in one table bucketed by batch, so text is shuffled once.  What a common
passage sends to a shard is one entry per batch, not per document.  Grams with so many
contexts that their shard would grow with the corpus are found first, from counts of all
batches; the 50-byte strings over them take the place of their contexts, which spreads
them over all shards.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepipe.llm.common import shared_folder, text_or_empty, written

LENGTH = 50
GRAM = 20
#: Bytes before a gram that a string over it can begin with.
LEAD = LENGTH - GRAM
#: Depth in bytes of the quicksort; deeper groups go to blind tries.
SHALLOW = 16
BATCH_BYTES = 16 << 20
#: Buckets of the table of batches; beyond so many batches a bucket holds several.
MAX_BUCKETS = 1 << 14
#: Expected anchors for each gram shard.
SHARD_ANCHORS = 1 << 20
#: A gram with more contexts is dealt by whole strings; so many as there are at least.
HOT_CONTEXTS = 20_000
#: A hot gram has at least this share of all bytes in contexts, which bounds their number.
HOT_SHARE = 1 << 23

_ROOT = 0x9E3779B97F4A7C15
_MIX = 0xBF58476D1CE4E5B9


# --- anchors ----------------------------------------------------------------------


class Roller:
    """Hashes of all stretches of a byte string, from prefix sums of weighted byte codes."""

    def __init__(self, seed: int = 3):
        self.code = np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(2 * len(self.up), n + 1)
            for name, base in (("up", _ROOT), ("down", pow(_ROOT, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._powers(len(data))
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.code[data] * self.up[: len(data)])))

    def hashes(self, sums: np.ndarray, start: np.ndarray | slice, stop: np.ndarray | slice) -> np.ndarray:
        h = (sums[stop] - sums[start]) * self.down[start]
        h ^= h >> np.uint64(29)
        h *= np.uint64(_MIX)
        return h ^ (h >> np.uint64(32))


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        values = pick(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, roller: Roller) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the anchors, hashes of gram and context, and the prefix sums."""
    n = len(data)
    sums = roller.sums(data)
    grams = roller.hashes(sums, slice(0, n - GRAM + 1), slice(GRAM, n + 1))
    span = LEAD + 1
    least = _sliding(grams, span, np.minimum)
    zeros = np.zeros(LEAD, np.uint64)
    at = np.flatnonzero(_sliding(np.concatenate((zeros, least, zeros)), span, np.maximum) == grams)
    start, stop = np.maximum(at - LEAD, 0), np.minimum(at + LENGTH, n)
    place = ((at - start) * 128 + (stop - at)).astype(np.uint64)
    context = roller.hashes(sums, start, stop) ^ (place * np.uint64(_ROOT))
    return at, grams[at], context, sums


class Entries:
    """What stands for a document's strings: contexts of anchors, and strings over hot grams.

    A string over a hot gram is an entry of its own, with its hash as the gram and an
    independent hash as the context, so no two different ones share a gram.
    """

    def __init__(self, hot: np.ndarray):
        self.hot, self.roller, self.second = hot, Roller(), Roller(seed=5)

    def of(self, data: np.ndarray) -> tuple[np.ndarray, ...]:
        """Start, stop and anchor of each entry, its gram and context, and the prefix sums."""
        n = len(data)
        at, gram, context, sums = anchors(data, self.roller)
        start, stop = np.maximum(at - LEAD, 0), np.minimum(at + LENGTH, n)
        if not len(self.hot):
            return start, stop, at, gram, context, sums
        is_hot = self.hot[np.minimum(np.searchsorted(self.hot, gram), len(self.hot) - 1)] == gram
        if not is_hot.any():
            return start, stop, at, gram, context, sums
        change = np.zeros(n + 2, np.int64)
        np.add.at(change, start[is_hot], 1)
        # The last string over a gram begins at the gram, or as late as the text allows.
        np.add.at(change, np.maximum(np.minimum(at[is_hot], n - LENGTH) + 1, start[is_hot]), -1)
        own = np.flatnonzero(np.cumsum(change) > 0)
        whole, cold = self.roller.hashes(sums, own, own + LENGTH), ~is_hot
        again = self.second.hashes(self.second.sums(data), own, own + LENGTH)
        return (
            np.concatenate((start[cold], own)),
            np.concatenate((stop[cold], own + LENGTH)),
            np.concatenate((at[cold], own)),
            np.concatenate((gram[cold], whole)),
            np.concatenate((context[cold], again)),
            sums,
        )


def _bytes(text: object) -> np.ndarray:
    return np.frombuffer(text if isinstance(text, bytes) else b"", np.uint8)


def _planes(values: np.ndarray) -> bytes:
    """The bytes of 64-bit values plane by plane, so that equal high bytes lie together."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplanes(data: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(kind).ravel()


# --- hot grams ----------------------------------------------------------------------


def count_contexts(batch: pd.DataFrame) -> pd.DataFrame:
    """Distinct contexts in a batch of each gram that has two or more there."""
    roller, parts = Roller(), []
    for text in batch["body"]:
        data = _bytes(text)
        if len(data) >= LENGTH:
            parts.append(np.stack(anchors(data, roller)[1:3]))
    gram, context = np.concatenate(parts, axis=1) if parts else np.zeros((2, 0), np.uint64)
    order = np.lexsort((context, gram))
    gram, context = gram[order], context[order]
    new = np.concatenate(([True], (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])))[: len(gram)]
    grams, n = np.unique(gram[new], return_counts=True)
    return pd.DataFrame({"gram": grams[n > 1].view(np.int64), "n": n[n > 1]})


def hot_grams(docs: DataFrame, total: int, hot_contexts: int) -> np.ndarray:
    """Sorted hashes of the grams with at least ``hot_contexts`` contexts and a HOT_SHARE of all bytes.

    Each counted context begins at a byte of its own, so there are at most HOT_SHARE of
    them, 64 MB, at every size of the corpus; a gram that is left out sends a shard fewer
    entries than that limit and one for each batch.
    """
    least = max(hot_contexts, -(-total // HOT_SHARE))
    counts = docs.select("batch", "body").groupBy("batch").applyInPandas(count_contexts, "gram long, n long")
    found = counts.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("gram").toArrow()
    return np.sort(found["gram"].to_numpy().astype(np.int64).view(np.uint64))


# --- step 1: what a batch sends -----------------------------------------------------

SENT = "shard int, batch int, gram binary, context binary, doc binary, several binary"


def _sender(shards: int, hot: Broadcast):
    def send(batch: pd.DataFrame) -> pd.DataFrame:
        entries, parts = Entries(hot.value), []
        for doc, text in zip(batch["doc"].to_numpy(np.int64), batch["body"]):
            data = _bytes(text)
            if len(data) >= LENGTH:
                _, _, _, gram, context, _ = entries.of(data)
                parts.append((gram, context, np.full(len(gram), doc)))
        if not parts:
            return pd.DataFrame({c.split()[0]: [] for c in SENT.split(", ")})
        gram, context, doc = (np.concatenate(x) for x in zip(*parts))
        # One entry for each gram and context: the batch's first document, and whether others follow.
        order = np.lexsort((doc, context))
        gram, context, doc = gram[order], context[order], doc[order]
        first = np.flatnonzero(np.concatenate(([True], (context[1:] != context[:-1]) | (gram[1:] != gram[:-1]))))
        several = np.maximum.reduceat(doc, first) > doc[first]
        gram, context, doc = gram[first], context[first], doc[first]
        shard = (gram % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((doc, shard))
        gram, context, doc, several, shard = (x[order] for x in (gram, context, doc, several, shard))
        cuts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1])))
        rows = []
        for a, b in zip(cuts, [*cuts[1:], len(shard)]):
            rows.append(
                (
                    int(shard[a]),
                    int(batch["batch"].iloc[0]),
                    (gram[a:b] >> np.uint64(32)).astype(np.uint32).tobytes(),
                    context[a:b].tobytes(),
                    _planes(doc[a:b]),
                    np.packbits(several[a:b]).tobytes(),
                )
            )
        return pd.DataFrame(rows, columns=[c.split()[0] for c in SENT.split(", ")])

    return send


# --- step 2: what a shard answers ----------------------------------------------------

ANSWERED = "batch int, context binary, first binary, look binary"
#: What the first document of a context has to do: nothing, send the context, send its strings.
_NOTHING, _SEND, _SEND_STRINGS = 0, 1, 2


def _answerer(hot_contexts: int):
    def answer(shard: pd.DataFrame) -> pd.DataFrame:
        """For each batch the contexts that matter to it, with their first document."""
        counts = [len(x) // 4 for x in shard["gram"]]
        gram = np.frombuffer(b"".join(shard["gram"]), np.uint32)
        context = np.frombuffer(b"".join(shard["context"]), np.uint64)
        doc = np.concatenate([_unplanes(x, np.int64) for x in shard["doc"]])
        several = np.concatenate(
            [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(shard["several"], counts)]
        ).astype(bool)
        row = np.repeat(np.arange(len(counts)), counts)
        order = np.lexsort((doc, context, gram))
        gram, context, doc, several, row = (x[order] for x in (gram, context, doc, several, row))

        new_gram = np.concatenate(([True], gram[1:] != gram[:-1]))
        new_context = new_gram | np.concatenate(([True], context[1:] != context[:-1]))
        gram_at, context_at = np.flatnonzero(new_gram), np.flatnonzero(new_context)
        gram_of, context_of = np.cumsum(new_gram) - 1, np.cumsum(new_context) - 1
        first = doc[context_at][context_of]
        contexts = np.add.reduceat(new_context.astype(np.int64), gram_at)
        shared = (np.minimum.reduceat(doc, gram_at) < np.maximum.reduceat(doc, gram_at)) | np.logical_or.reduceat(several, gram_at)
        look = np.where(contexts > hot_contexts, _SEND_STRINGS, np.where(contexts > 1, _SEND, _NOTHING))[gram_of]
        look = np.where(shared[gram_of] & (doc == first), look, _NOTHING).astype(np.uint8)
        matters = shared[gram_of] & ((first < doc) | several | (look > 0))
        context, first, look, row = (x[matters] for x in (context, first, look, row))

        order = np.lexsort((first, row))
        context, first, look, row = (x[order] for x in (context, first, look, row))
        cuts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else []
        batches = shard["batch"].to_numpy()
        return pd.DataFrame(
            [
                (int(batches[row[a]]), context[a:b].tobytes(), _planes(first[a:b]), look[a:b].tobytes())
                for a, b in zip(cuts, [*cuts[1:], len(row)])
            ],
            columns=[c.split()[0] for c in ANSWERED.split(", ")],
        )

    return answer


# --- step 3: contexts to sort, and spans that need no sorting --------------------------

FOUND = "kind int, batch int, doc long, row long, key long, at long, lead int, context binary, spans binary"
_SPANS, _CONTEXT = 0, 1


def _merged(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Overlapping and touching spans made one, as rows of start and stop."""
    if not len(start):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    new = np.concatenate(([True], start[1:] > reach[:-1]))
    ends = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(start) - 1]))
    return np.stack((start[new], reach[ends]), axis=1).astype(np.int64)


def _looker(hot: Broadcast):
    def look_up(batch: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        """Spans of a batch's documents that are covered whole, and the contexts they have to send."""
        columns = [c.split()[0] for c in FOUND.split(", ")]
        if not len(answers) or not len(batch):
            return pd.DataFrame({c: [] for c in columns})
        known = np.frombuffer(b"".join(answers["context"]), np.uint64)
        first = np.concatenate([_unplanes(x, np.int64) for x in answers["first"]])
        look = np.frombuffer(b"".join(answers["look"]), np.uint8)
        order = np.argsort(known, kind="stable")
        known, first, look = known[order], first[order], look[order]
        number, entries, rows = int(batch["batch"].iloc[0]), Entries(hot.value), []
        for doc, row, text in zip(batch["doc"].tolist(), batch["row"].tolist(), batch["body"]):
            data = _bytes(text)
            if len(data) < LENGTH:
                continue
            start, stop, at, gram, context, sums = entries.of(data)
            place = np.minimum(np.searchsorted(known, context), len(known) - 1)
            hit = known[place] == context
            covered = hit & (first[place] < doc)
            whole = covered & (stop - start >= LENGTH)
            if whole.any():
                rows.append((_SPANS, number, doc, row, 0, 0, 0, None, _merged(start[whole], stop[whole]).tobytes()))
            asked = np.flatnonzero(hit & (first[place] == doc) & (look[place] > 0) & (stop - start >= LENGTH))
            for i in asked.tolist():
                a, b, p = int(start[i]), int(stop[i]), int(at[i])
                own = data[a:b].tobytes()
                if look[place[i]] == _SEND:
                    rows.append((_CONTEXT, number, doc, row, int(gram[i : i + 1].view(np.int64)[0]), p, p - a, own, None))
                    continue
                for s in range(a, min(p, b - LENGTH) + 1):
                    key = int(entries.roller.hashes(sums, np.array([s]), np.array([s + LENGTH])).view(np.int64)[0])
                    piece = own[s - a : s - a + LENGTH]
                    rows.append((_CONTEXT, number, doc, row, key, p, p - s, piece, None))
        return pd.DataFrame(rows, columns=columns)

    return look_up


# --- deep-shallow sorting -------------------------------------------------------------


def multikey_groups(strings: np.ndarray, key: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``strings`` (bytes) by key and their first ``depth`` bytes, and group starts.

    Multikey quicksort with characters of eight bytes: each round sorts by one character
    inside the groups that the earlier characters left, and splits those groups.
    """
    order = np.argsort(key, kind="stable")
    group = np.cumsum(np.concatenate(([0], key[order][1:] != key[order][:-1])))
    for i in range(0, depth, 8):
        block = np.zeros((len(strings), 8), np.uint8)
        block[:, : min(8, strings.shape[1] - i)] = strings[:, i : i + 8]
        character = block.view(">u8").ravel().astype(np.uint64)
        inner = np.lexsort((character[order], group))
        order, group = order[inner], group[inner]
        sorted_ = character[order]
        group = np.cumsum(np.concatenate(([0], (group[1:] != group[:-1]) | (sorted_[1:] != sorted_[:-1]))))
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(order) else np.zeros(0, np.int64)
    return order, starts


class BlindTrie:
    """Patricia trie that keeps branching positions only; a search looks at few bytes of a string.

    Inner nodes are ``[position, {byte: child}]``, leaves the numbers of the classes of
    equal strings.
    """

    def __init__(self):
        self.root = None
        self.strings: list[bytes] = []

    def insert(self, string: bytes) -> int:
        """The class of the string."""
        if self.root is None:
            self.root = self._new(string)
            return self.root
        node = self.root
        while not isinstance(node, int):
            children = node[1]
            node = children.get(string[node[0]])
            if node is None:
                node = next(iter(children.values()))
        other = self.strings[node]
        if other == string:
            return node
        # The blind search ends at a string with the longest common prefix; branch behind it.
        a, b = int.from_bytes(string), int.from_bytes(other)
        at = len(string) - ((a ^ b).bit_length() + 7) // 8
        parent, node = None, self.root
        while not isinstance(node, int) and node[0] < at:
            parent, node = node, node[1][string[node[0]]]
        leaf = self._new(string)
        if not isinstance(node, int) and node[0] == at:
            node[1][string[at]] = leaf
            return leaf
        branch = [at, {other[at]: node, string[at]: leaf}]
        if parent is None:
            self.root = branch
        else:
            parent[1][string[parent[0]]] = branch
        return leaf

    def _new(self, string: bytes) -> int:
        self.strings.append(string)
        return len(self.strings) - 1

    def ordered(self) -> Iterator[int]:
        """Classes in the order of their strings."""
        pending = [self.root] if self.root is not None else []
        while pending:
            node = pending.pop()
            if isinstance(node, int):
                yield node
            else:
                pending.extend(node[1][c] for c in sorted(node[1], reverse=True))


def string_classes(strings: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Class of each row of ``strings``: rows of one key and equal bytes share a class, in sorted order."""
    order, starts = multikey_groups(strings, key, SHALLOW)
    stops = np.concatenate((starts[1:], [len(order)])).astype(np.int64)
    label, number = np.zeros(len(order), np.int64), 0
    tail = np.ascontiguousarray(strings[:, SHALLOW:])
    flat, width = tail.tobytes(), tail.shape[1]
    for a, b in zip(starts.tolist(), stops.tolist()):
        members = order[a:b].tolist()
        if len(members) == 1:
            label[members[0]] = number
            number += 1
            continue
        trie = BlindTrie()
        own = [trie.insert(flat[m * width : (m + 1) * width]) for m in members]
        rank = {c: number + i for i, c in enumerate(trie.ordered())}
        label[members] = [rank[c] for c in own]
        number += len(rank)
    return label


def _agreement(parts: np.ndarray, length: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Bytes that each row has in common, from the front, with the best other row of its key."""
    # The length comes last: a short part padded with zeros must not stand between longer ones that hold NULs.
    by_length = np.hstack((parts, length[:, None].astype(np.uint8)))
    order, _ = multikey_groups(by_length, key, by_length.shape[1])
    sorted_, lengths = parts[order], length[order]
    differs = sorted_[1:] != sorted_[:-1]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), parts.shape[1])
    common = np.minimum(common, np.minimum(lengths[1:], lengths[:-1]))
    common[key[order][1:] != key[order][:-1]] = 0
    best = np.zeros(len(order), np.int64)
    best[:-1] = common
    best[1:] = np.maximum(best[1:], common)
    out = np.zeros(len(order), np.int64)
    out[order] = best
    return out


COVERED = "batch int, doc long, row long, spans binary"


def sort_contexts(part: pd.DataFrame) -> pd.DataFrame:
    """Spans of the documents' strings that an earlier document of this shard holds too."""
    n = len(part)
    key, doc = part["key"].to_numpy(np.int64), part["doc"].to_numpy(np.int64)
    at, lead = part["at"].to_numpy(np.int64), part["lead"].to_numpy(np.int64)
    # Left parts reversed, right parts as they are; both begin at the gram.
    left, right = np.zeros((n, LEAD), np.uint8), np.zeros((n, LENGTH), np.uint8)
    behind = np.zeros(n, np.int64)
    for i, (context, k) in enumerate(zip(part["context"], lead.tolist())):
        data = np.frombuffer(context, np.uint8)
        left[i, :k] = data[:k][::-1]
        behind[i] = len(data) - k
        right[i, : len(data) - k] = data[k:]
    common_right, common_left = _agreement(right, behind, key), _agreement(left, lead, key)
    low = np.maximum(0, LENGTH - np.minimum(common_right, behind))
    high = np.minimum(lead, common_left)
    count = np.maximum(0, high - low + 1)
    owner = np.repeat(np.arange(n), count)
    if not len(owner):
        return pd.DataFrame({c.split()[0]: [] for c in COVERED.split(", ")})
    before = low[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    whole = np.hstack((left[:, ::-1], right))
    strings = np.lib.stride_tricks.sliding_window_view(whole, LENGTH, axis=1)[owner, LEAD - before]
    # A string's place relative to its gram belongs to its key.
    label = string_classes(strings, (key[owner] << 6) ^ before)
    first = np.full(label.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(first, label, doc[owner])
    covered = first[label] < doc[owner]
    owner, start = owner[covered], (at[owner] - before)[covered]
    rows, batches, row = [], part["batch"].to_numpy(), part["row"].to_numpy(np.int64)
    order = np.lexsort((start, row[owner], doc[owner]))
    owner, start = owner[order], start[order]
    new = (doc[owner][1:] != doc[owner][:-1]) | (row[owner][1:] != row[owner][:-1])
    cuts = np.flatnonzero(np.concatenate(([True], new))) if len(owner) else []
    for a, b in zip(cuts, [*cuts[1:], len(owner)]):
        i, spans = owner[a], _merged(start[a:b], start[a:b] + LENGTH)
        rows.append((int(batches[i]), int(doc[i]), int(row[i]), spans.tobytes()))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in COVERED.split(", ")])


# --- step 4: cutting --------------------------------------------------------------------

CUT = "no_id boolean, doc long, n_bytes long, n_removed long, spans array<struct<start:long,stop:long>>, kept binary"


def cut(batch: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
    """Every document of a batch less its spans."""
    own: dict[tuple[int, int], list[bytes]] = {}
    for doc, row, spans in zip(found["doc"].tolist(), found["row"].tolist(), found["spans"]):
        own.setdefault((doc, row), []).append(spans)
    rows = []
    for no_id, doc, row, data in zip(batch["no_id"], batch["doc"].tolist(), batch["row"].tolist(), batch["body"]):
        spans = np.frombuffer(b"".join(own.get((doc, row), [])), np.int64).reshape(-1, 2)
        merged = _merged(spans[:, 0], spans[:, 1])
        pieces, at = [], 0
        for start, stop in merged.tolist():
            pieces.append(data[at:start])
            at = stop
        pieces.append(data[at:])
        removed = int((merged[:, 1] - merged[:, 0]).sum())
        rows.append(
            (bool(no_id), doc, len(data), removed, [{"start": a, "stop": b} for a, b in merged.tolist()], b"".join(pieces))
        )
    return pd.DataFrame(rows, columns=["no_id", "doc", "n_bytes", "n_removed", "spans", "kept"])


def remove_repeats(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_bytes: int = BATCH_BYTES,
    hot_contexts: int = HOT_CONTEXTS,
) -> DataFrame:
    """One row per row of ``df``: id, ``n_bytes``, ``n_removed``, ``spans`` and the ``kept`` bytes.

    Texts are taken as UTF-8 bytes, null as empty; texts under 50 bytes are kept whole.  A
    null id counts as smaller than any other.  Rows with equal ids do not cover each other,
    whether their texts differ or repeat.  Strings are judged on the input, not on what is
    left.  An empty table gives an empty result; other columns of ``df`` are not carried.
    """
    spark = df.sparkSession
    body = F.encode(text_or_empty(text_col), "UTF-8")
    total = df.agg(F.sum(F.octet_length(text_or_empty(text_col)))).first()[0] or 0
    batches = max(1, -(-total // batch_bytes))
    shards = max(1, -(-total // (15 * SHARD_ANCHORS)))
    dealt = df.select(
        F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(batches)).cast("int").alias("batch"),
        F.col(id_col).isNull().alias("no_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("doc"),
        F.xxhash64(F.col(text_col)).alias("row"),
        body.alias("body"),
    )
    name = f"llm_batches_{uuid.uuid4().hex}"
    buckets = min(batches, MAX_BUCKETS)
    (
        dealt.repartition(buckets, "batch")
        .write.bucketBy(buckets, "batch")
        .option("compression", "zstd")
        .option("path", f"{shared_folder(spark)}/{name}")
        .saveAsTable(name)
    )
    docs = spark.table(name)

    hot = spark.sparkContext.broadcast(hot_grams(docs, total, hot_contexts))
    sent = docs.groupBy("batch").applyInPandas(_sender(shards, hot), SENT)
    answers = written(sent.groupBy("shard").applyInPandas(_answerer(hot_contexts), ANSWERED), "answers")
    found = written(docs.groupBy("batch").cogroup(answers.groupBy("batch")).applyInPandas(_looker(hot), FOUND), "found")
    contexts = (
        found.where(F.col("kind") == _CONTEXT)
        .withColumn("part", F.pmod(F.xxhash64("key"), F.lit(4 * shards)))
        .groupBy("part")
        .applyInPandas(sort_contexts, COVERED)
    )
    spans = written(contexts.unionByName(found.where(F.col("kind") == _SPANS).select("batch", "doc", "row", "spans")), "spans")
    return (
        docs.groupBy("batch")
        .cogroup(spans.groupBy("batch"))
        .applyInPandas(cut, CUT)
        .select(F.when(~F.col("no_id"), F.col("doc")).alias(id_col), "n_bytes", "n_removed", "spans", "kept")
    )
