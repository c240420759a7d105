"""SimHash near-deduplication with vantage-point trees.

Fingerprints of 64 bits link when at most three bits differ; linked documents form
components.  Of two linked fingerprints at least one half (32 bits) differs in at most
one bit, so there is one vantage-point tree per half, searched with radius one: a small
radius is what makes triangle bounds cut off most of a tree.

A tree's upper part is built on the driver from a bounded sample and decides only how
work is dealt: an inner node holds a vantage point and a median distance, a leaf is a
shard.  Every distinct fingerprint has one home shard and is also sent as a query to each
shard that its ball overlaps.  Inside a shard the tree is continued over the shard's own
fingerprints, and what no bound cuts off is compared in full.  A shard gives out spanning
links, not all pairs, and the links of all shards are joined by star contraction in
Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepipe.llm.common import unused, written

SHINGLE = 3
SEED = 42
DISTANCE = 3
#: Radius inside a half that finds every pair within DISTANCE.
RADIUS = DISTANCE // 2
#: Distinct fingerprints that a shard is meant to hold, and that a local leaf holds.
SHARD_SIZE = 4096
LEAF_SIZE = 128
#: Fingerprints sampled for each shard to place its tree's vantage points.
SAMPLE_PER_SHARD = 24
#: Upper trees end here, a quarter of a billion distinct fingerprints on; shards beyond it grow,
#: and are searched by deeper local trees.  At 20 billion a shard has some 20 million narrow rows.
MAX_SHARDS = 1 << 16
#: Fingerprints that a task walks through an upper tree at once, and rows it hands out at once.
DEAL_AT_ONCE = 1 << 18


# --- fingerprints -----------------------------------------------------------------


def fingerprint(text: str | None) -> int:
    """SimHash of the whole text's three-word shingles as a signed 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(SHINGLE, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    n = len(words) - k + 1
    hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 15):
        block = hashes[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


@F.pandas_udf(T.LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t if isinstance(t, str) else None) for t in texts], dtype="int64")


# --- vantage-point trees ----------------------------------------------------------


class Tree:
    """Vantage-point tree over 32-bit values under Hamming distance, as flat lists."""

    def __init__(self, values: np.ndarray, leaf_size: int):
        self.vantage: list[int] = []
        self.radius: list[int] = []
        self.inner: list[int] = []
        self.outer: list[int] = []
        self.leaves = 0
        self.root = self._build(values, leaf_size)

    def _build(self, values: np.ndarray, leaf_size: int) -> int:
        """A node's number, or ``-1 - leaf`` for a leaf."""
        split = _vantage_point(values) if len(values) > leaf_size else None
        if split is None:
            self.leaves += 1
            return -self.leaves
        point, radius = split
        near = np.bitwise_count(values ^ point) <= radius
        node = len(self.vantage)
        self.vantage.append(int(point))
        self.radius.append(int(radius))
        self.inner.append(0)
        self.outer.append(0)
        self.inner[node] = self._build(values[near], leaf_size)
        self.outer[node] = self._build(values[~near], leaf_size)
        return node

    def route(self, values: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each leaf the positions in ``values`` whose ball of radius ``reach`` overlaps it.

        Triangle bounds: within ``reach`` of a value at distance d from the vantage point
        lie only values at distances d - reach to d + reach.
        """
        pending = [(self.root, np.arange(len(values)))]
        while pending:
            node, at = pending.pop()
            if not len(at):
                continue
            if node < 0:
                yield -1 - node, at
                continue
            d = np.bitwise_count(values[at] ^ np.uint32(self.vantage[node])).astype(np.int64)
            pending.append((self.inner[node], at[d - reach <= self.radius[node]]))
            pending.append((self.outer[node], at[d + reach > self.radius[node]]))


def _vantage_point(values: np.ndarray) -> tuple[np.uint32, int] | None:
    """Of a few candidates the one whose cut sends the fewest values both ways."""
    best = None
    for point in values[np.linspace(0, len(values) - 1, 8).astype(int)]:
        d = np.bitwise_count(values ^ point).astype(np.int64)
        radius = int(np.median(d))
        for cut in (radius - 1, radius):
            near = int((d <= cut).sum())
            if 0 < near < len(values):
                both = int(((d - RADIUS <= cut) & (d + RADIUS > cut)).sum())
                cost = max(near, len(values) - near) + both
                if best is None or cost < best[0]:
                    best = (cost, point, cut)
    return best and (best[1], best[2])


def half(values: np.ndarray, which: int) -> np.ndarray:
    """The low (0) or high (1) 32 bits."""
    return np.ascontiguousarray(values).view(np.uint32)[which::2]


# --- linking ----------------------------------------------------------------------


def _block_links(queries: np.ndarray, stored: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that span what ``queries`` and ``stored`` have within DISTANCE of each other."""
    step = max(1, (1 << 21) // max(1, len(stored)))
    for i in range(0, len(queries), step):
        q = queries[i : i + step]
        # Of a signed number NumPy counts the bits of its absolute value.
        apart = np.bitwise_count(q.view(np.uint64)[:, None] ^ stored.view(np.uint64)[None, :])
        close = apart <= DISTANCE
        some = (close & (apart > 0)).any(axis=1)
        if not some.any():
            continue
        q, close = q[some], close[some]
        columns = close.any(axis=0)
        s, close = stored[columns], close[:, columns]
        # Smallest label that reaches each row and column, until nothing changes.
        high = np.iinfo(np.int64).max
        row_label, column_label = np.arange(len(q)), None
        while True:
            column_label = np.where(close, row_label[:, None], high).min(axis=0)
            new = np.where(close, column_label[None, :], high).min(axis=1)
            if (new == row_label).all():
                break
            row_label = new
        yield q, q[row_label]
        yield s, q[column_label]


def spanning_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One link to its component's smallest member for each other member of the graph of a-b."""
    nodes, flat = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def shard_links(shard: pd.DataFrame) -> pd.DataFrame:
    """Spanning links between a shard's fingerprints and those whose balls overlap it."""
    which = int(shard["tree"].iloc[0])
    queries = shard["fp"].to_numpy(np.int64)
    stored = queries[shard["home"].to_numpy(bool)]
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(stored):
        tree = Tree(half(stored, which), LEAF_SIZE)
        homes = dict(tree.route(half(stored, which), 0))
        pending = 0
        for leaf, at in tree.route(half(queries, which), RADIUS):
            if leaf not in homes:
                continue
            for x, y in _block_links(queries[at], stored[homes[leaf]]):
                a.append(x)
                b.append(y)
                pending += len(x)
            if pending > 1 << 20:
                x, y = spanning_links(np.concatenate(a), np.concatenate(b))
                a, b, pending = [x], [y], len(x)
    x, y = spanning_links(np.concatenate(a), np.concatenate(b))
    return pd.DataFrame({"a": x, "b": y})


def _gathered(batches: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
    """Fingerprints of many batches at once: a walk through a tree costs the same for few as for many."""
    held, size = [], 0
    for batch in batches:
        held.append(batch["fp"].to_numpy(np.int64))
        size += len(batch)
        if size >= DEAL_AT_ONCE:
            yield np.concatenate(held)
            held, size = [], 0
    if size:
        yield np.concatenate(held)


def _dealer(trees: list[dict]) -> Callable:
    def dealt(which: int, fps: np.ndarray, home: np.ndarray, parts: list[tuple[int, np.ndarray]]) -> pd.DataFrame:
        at = np.concatenate([x for _, x in parts])
        shard = np.repeat(np.array([leaf for leaf, _ in parts], np.int32), [len(x) for _, x in parts])
        return pd.DataFrame({"tree": np.int32(which), "shard": shard, "fp": fps[at], "home": home[at] == shard})

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for fps in _gathered(batches):
            for which, state in enumerate(trees):
                tree = Tree.__new__(Tree)
                tree.__dict__ = state
                values = half(fps, which)
                home = np.full(len(fps), -1)
                for leaf, at in tree.route(values, 0):
                    home[at] = leaf
                parts, size = [], 0
                for leaf, at in tree.route(values, RADIUS):
                    parts.append((leaf, at))
                    size += len(at)
                    if size >= DEAL_AT_ONCE:
                        yield dealt(which, fps, home, parts)
                        parts, size = [], 0
                if parts:
                    yield dealt(which, fps, home, parts)

    return deal


def links(fps: DataFrame) -> DataFrame:
    """Links ``a, b`` that connect whatever distinct fingerprints ``fp`` are within DISTANCE."""
    n = fps.count()
    shards = min(MAX_SHARDS, max(1, -(-n // SHARD_SIZE)))
    wanted = shards * SAMPLE_PER_SHARD
    sample = fps.select("fp").sample(fraction=min(1.0, 1.2 * wanted / max(1, n)), seed=SEED).limit(2 * wanted)
    points = np.sort(sample.toArrow()["fp"].to_numpy().astype(np.int64))
    trees = []
    for which in (0, 1):
        tree = Tree(half(points, which) if len(points) else np.zeros(0, np.uint32), SAMPLE_PER_SHARD * 2 if shards > 1 else len(points))
        trees.append(tree.__dict__)
    return (
        fps.select("fp")
        .mapInPandas(_dealer(trees), "tree int, shard int, fp long, home boolean")
        .groupBy("tree", "shard")
        .applyInPandas(shard_links, "a long, b long")
    )


# --- components -------------------------------------------------------------------


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def contract(edges: DataFrame) -> DataFrame:
    """Every node ``a`` with the smallest node ``b`` that links reach from it, isolated ones left out.

    Large-star and small-star steps in turn, each step's links written to the shared
    folder, until no link changes.
    """
    pair = F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")
    edges = written(edges.where("a <> b").select(*pair).select("a", "b").distinct(), "links")
    before = None
    while True:
        now = _state(edges)
        if not now[0] or now == before:
            return edges
        before = now
        # Large star: larger neighbours of a node link to the smallest of its neighbours and itself.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("low")), "least")
        large = written(_to_least(both.where("b > a"), least).where("a <> b").distinct(), "links")
        # Small star: a node and its smaller neighbours link to the smallest of them.
        least = written(large.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")), "least")
        own = least.select(F.col("node").alias("a"), F.col("low").alias("b"))
        edges = written(_to_least(large, least).unionByName(own).where("a <> b").distinct(), "links")


def _to_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """A link from each ``b`` to the ``low`` of its ``a``.

    ``least`` is a written table: a join with the aggregate itself would share its exchange,
    which adaptive execution leaves whole, and the links of a hub would meet in one task.
    """
    return edges.join(least, edges["a"] == least["node"]).select(F.col("b").alias("a"), F.col("low").alias("b"))


def _rooted(df: DataFrame, id_col: str, text_col: str, root: str) -> DataFrame:
    """The rows of ``components``, and as ``root`` the smallest fingerprint of each one's component."""
    results = (text_col, "fingerprint", "component_id")
    columns = [c for c in df.columns if c not in results]
    node, least = unused(df.withColumn(root, F.lit(0)), "node_", "least_")
    rows = written(df.select(*columns, fingerprints(F.col(text_col)).alias("fingerprint")), "fingerprints")
    distinct = written(rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(id_col).alias("first_id")), "distinct")
    stars = contract(links(distinct))
    rooted = distinct.join(stars, distinct["fp"] == stars["a"], "left").select(
        "fp", "first_id", F.coalesce("b", "fp").alias(root)
    )
    rooted = written(rooted, "rooted")
    # Written for the same reason as in ``_to_least``: a component may be a third of all nodes.
    smallest = written(rooted.groupBy(root).agg(F.min("first_id").alias(least)), "smallest")
    named = written(rooted.join(smallest, root).select(F.col("fp").alias(node), root, least), "components")
    return rows.join(named, F.col("fingerprint") == F.col(node)).select(
        *columns, "fingerprint", F.col(least).alias("component_id"), root
    )


def components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``df`` but the text, plus ``fingerprint`` and ``component_id``.

    ``fingerprint`` is a signed long; ``component_id`` is the smallest id reachable over
    links, the row's own included.  Texts with no word, null ones among them, have
    fingerprint zero and link like any other.  Null ids never name a component that has
    another id.  Equal fingerprints are one node, so groups of copies cost nothing here.
    An empty table gives an empty result.  Columns of ``df`` with the names of result
    columns are replaced.
    """
    [root] = unused(df, "root_")
    return _rooted(df, id_col, text_col, root).drop(root)


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, unchanged, less all but one of each component.

    The row with the smallest id stays; among rows that repeat it, the one with the
    smallest hash of all columns.  Components without any id keep one row each too, and an
    id that occurs in two components can stay in both: a component is known by its root
    fingerprint, not by its smallest id.
    """
    tie, best, root, kept = unused(df, "tie_", "best_", "root_", "kept_")
    rows = df.withColumn(tie, F.xxhash64(*df.columns))
    found = _rooted(rows.select(id_col, tie, text_col), id_col, text_col, root)
    # The null-last order of ids, and one row per component: partial maxima first.
    first = found.groupBy(root).agg(
        F.max(F.struct((-F.col(id_col)).alias("id"), (-F.col(tie)).alias("tie"))).alias(best)
    )
    keep = written(first.select((-F.col(best)["id"]).alias(kept), (-F.col(best)["tie"]).alias(best)), "kept")
    one = rows.join(keep, F.col(id_col).eqNullSafe(F.col(kept)) & (F.col(tie) == F.col(best)), "left_semi")
    # Whole rows that repeat are rare; only then is there one more step.
    if found.groupBy(id_col, tie).count().where("count > 1").limit(1).count():
        one = one.dropDuplicates([id_col, tie])
    return one.select(*df.columns)
