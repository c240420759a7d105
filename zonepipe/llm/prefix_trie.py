"""Conversation prefix trie by truncation peeling.

The trie's nodes are the distinct sequences of first turns.  Peeling starts at the depth of
the longest conversation: conversations that end there are merged into nodes, every node
loses its last turn and becomes a contribution to its parent, and contributions are
regrouped together with the conversations that end one level higher.  Nodes are found and
their figures added up in the same step, so the trie is never expanded again.

Spark sorts the distinct conversations by their turns over many tasks, and each task peels
blocks of neighbours.  What lies on a block's first or last path may go on in another block:
its figures are handed on, as at most two rows for a block, and peeled in the next round with
those of the other blocks, until one block holds all.  A round leaves at most two of 2048
rows, whatever turns they share: a first turn that a third of all conversations begin with
is spread over blocks like any other, and the number of jobs does not grow with depth.

Equal conversations are merged before the first round.  A sequence is known by its depth
and 128 bits, the exclusive or of a hash of every turn's position and SHA-256.  Texts are
read once and never shuffled.  A conversation is one row of 24 bytes a turn, and its turns
are numbered by one task, which streams them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonepipe.llm.common import text_or_empty, written

#: Neighbouring rows that are peeled together: at most so many, or so many prefixes on their
#: paths; at least LEAST_ROWS, so that every round leaves fewer.
BLOCK_ROWS = 2048
BLOCK_PREFIXES = 1 << 21
LEAST_ROWS = 16
#: Ids whose numbers agree but for so many low bits travel as one row: at most 4096 of them.
BLOCK_BITS = 12

NODE = ["depth", "a", "b", "parent_a", "parent_b", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
ROW = ["a_path", "b_path", "points", "conv_ids", "convs", "children", "leaves", "saved", "ends"]
PEELED = ", ".join(
    [f"{c} long" for c in NODE[:-1]] + ["ends_sha256 string"] + [f"{c} array<long>" for c in ROW[:-1]] + ["ends array<string>"]
)
#: A contribution of no conversation: any id is smaller.
NOTHING = ((1 << 63) - 1, 0, 0, 0, 0, None)
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
ENDED = "depth long, a long, b long, conv_id long, n_convs long, ends_sha256 string"


def turn_digests(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv_id, pos, digest, points`` of every turn: place from 1, SHA-256 of role and text, code points.

    Turns are ordered by ``turn_col``, null first; equal ones by their digest.  Null roles
    and texts count as empty, repeated rows as turns of their own.  Rows without a
    conversation are left out.
    """
    role, text = text_or_empty(role_col), text_or_empty(text_col)
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.sha2(told, 256).alias("digest"),
        F.length(text).cast("long").alias("points"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return turns.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "digest", "points")


def _levels(turns: DataFrame, members: DataFrame) -> DataFrame:
    """``conv_id, d, a, b, points``: every conversation's prefixes, the empty one included."""
    order = Window.partitionBy("conv_id").orderBy("pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = turns.select("conv_id", "pos", "digest", "points", F.row_number().over(order).cast("long").alias("d"))

    def prefix(salt: int) -> Column:
        return F.bit_xor(F.xxhash64(F.lit(salt), "d", "digest")).over(so_far)

    zero = F.lit(0).cast("long")
    roots = members.select("conv_id", *[zero.alias(c) for c in ("d", "a", "b", "points")])
    return placed.select("conv_id", "d", prefix(1).alias("a"), prefix(2).alias("b"), "points").unionByName(roots)


def _ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hashes the ids of each sequence as they come, sorted; only the running hash is held."""
    key, state = None, None
    for batch in batches:
        done = []
        for depth, a, b, ids, n, least in zip(*[batch[c] for c in ("depth", "a", "b", "ids", "n", "least")]):
            if (depth, a, b) != key:
                if key is not None:
                    done.append((*key, state[0], state[1], state[2].hexdigest()))
                key, state = (depth, a, b), [int(least), 0, hashlib.sha256()]
            state[2].update((b"," if state[1] else b"") + ids.encode())
            state[1] += int(n)
        yield pd.DataFrame(done, columns=["depth", "a", "b", "conv_id", "n_convs", "ends_sha256"])
    if key is not None:
        yield pd.DataFrame(
            [(*key, state[0], state[1], state[2].hexdigest())], columns=["depth", "a", "b", "conv_id", "n_convs", "ends_sha256"]
        )


def _ended(levels: DataFrame) -> DataFrame:
    """Equal conversations as one row: their number, smallest id, and the hash of all their ids.

    A hash needs its ids in order, so those of one sequence pass through one task, in
    blocks and without being held there.
    """
    tips = levels.groupBy("conv_id").agg(F.max(F.struct("d", "a", "b")).alias("tip"))
    blocks = (
        tips.groupBy(
            F.col("tip.d").alias("depth"),
            F.col("tip.a").alias("a"),
            F.col("tip.b").alias("b"),
            F.shiftright("conv_id", BLOCK_BITS).alias("block"),
        )
        .agg(F.sort_array(F.collect_list("conv_id")).alias("block_ids"))
        .select(
            "depth",
            "a",
            "b",
            "block",
            F.array_join(F.col("block_ids").cast("array<string>"), ",").alias("ids"),
            F.size("block_ids").cast("long").alias("n"),
            F.col("block_ids")[0].alias("least"),
        )
    )
    together = blocks.repartition("depth", "a", "b").sortWithinPartitions("depth", "a", "b", "block")
    return together.mapInPandas(_ends, ENDED)


def _paths(levels: DataFrame) -> DataFrame:
    """``conv_id, path``: a conversation's prefixes from the empty one, as one row."""
    return levels.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("d", "a", "b", "points"))).alias("path"))


def _peel(rows: list[tuple], whole: bool) -> tuple[list[tuple], list[tuple]]:
    """Nodes of neighbouring rows, and rows that hand on the nodes other blocks may share.

    A row is a path, as arrays ``a``, ``b`` and ``points`` by depth, and a contribution to
    each of its last nodes.  Sequences between two paths share no more than those two do, so
    only nodes on the first and on the last path can reach beyond the block; with ``whole``
    there is nothing beyond.
    """
    starts: list[list[tuple]] = [[] for _ in range(max(len(r[0]) for r in rows))]
    for r, row in enumerate(rows):
        first = len(row[0]) - len(row[3])
        for i, figures in enumerate(zip(*row[3:])):
            starts[first + i].append((r, figures))
    left, right = rows[0], rows[-1]
    kept_left, kept_right = {}, {}
    nodes, surviving = [], []
    for depth in range(len(starts) - 1, -1, -1):
        here: dict[tuple, list] = {}
        for r, (conv, n, children, leaves, saved, ends) in surviving + starts[depth]:
            key = (rows[r][0].item(depth), rows[r][1].item(depth))
            node = here.get(key)
            if node is None:
                here[key] = [r, conv, n, children, leaves, saved, ends]
            else:
                node[1] = min(node[1], conv)
                node[2] += n
                node[3] += children
                node[4] += leaves
                node[5] += saved
                node[6] = node[6] or ends
        surviving = []
        for key, (r, conv, n, children, leaves, saved, ends) in here.items():
            if not whole:
                if depth < len(right[0]) and key == (right[0].item(depth), right[1].item(depth)):
                    kept_right[depth] = (conv, n, children, leaves, saved, ends)
                    continue
                if depth < len(left[0]) and key == (left[0].item(depth), left[1].item(depth)):
                    kept_left[depth] = (conv, n, children, leaves, saved, ends)
                    continue
            a, b, points = rows[r][:3]
            leaves = leaves if children else 1
            saved += (n - 1) * points.item(depth)
            above = (a.item(depth - 1), b.item(depth - 1)) if depth else (None, None)
            nodes.append((depth, *key, *above, conv, n, children, leaves, saved, ends))
            surviving.append((r, (conv, n, 1, leaves, saved, None)))
    handed = []
    for row, kept in ((left, kept_left), (right, kept_right)):
        if kept:
            figures = [kept.get(d, NOTHING) for d in range(min(kept), len(row[0]))]
            handed.append((*row[:3], *map(list, zip(*figures))))
    return nodes, handed


def _peeler(whole: bool, block_rows: int):
    def peel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, prefixes = [], 0
        for batch in batches:
            arrays = [[x.values.to_numpy() for x in batch.column(c)] for c in ROW[:3]]
            for row in zip(*arrays, *[batch.column(c).to_pylist() for c in ROW[3:]]):
                rows.append(row)
                prefixes += len(row[0])
                if not whole and (len(rows) >= block_rows or prefixes >= BLOCK_PREFIXES and len(rows) >= LEAST_ROWS):
                    yield _told(*_peel(rows, whole))
                    rows, prefixes = [], 0
        if rows:
            yield _told(*_peel(rows, whole))

    return peel


def _told(nodes: list[tuple], handed: list[tuple]) -> pa.RecordBatch:
    """Nodes, then rows; each leaves the other's columns null."""
    columns = [[*c, *[None] * len(handed)] for c in zip(*nodes)] or [[None] * len(handed)] * len(NODE)
    columns += [[*[None] * len(nodes), *c] for c in zip(*handed)] or [[None] * len(nodes)] * len(ROW)
    kinds = [pa.int64()] * (len(NODE) - 1) + [pa.string()] + [pa.list_(pa.int64())] * (len(ROW) - 1) + [pa.list_(pa.string())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*NODE, *ROW])


def prefix_trie(turns: DataFrame, members: DataFrame | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The trie's nodes over ``conv_id, pos, digest, points`` rows, as ``turn_digests`` gives them.

    ``pos`` orders a conversation's turns and need not be gapless.  ``members`` names, in
    ``conv_id``, all conversations, turnless ones included; by default those with turns.
    Conversations are numbered by longs.  Per node: ``conv_id``, the smallest member;
    ``depth``; ``parent_conv_id``, null at the root; ``n_convs`` members; ``n_children``;
    ``n_leaves`` of the subtree; ``saved_tokens``, code points that storing the subtree's
    turns once saves; ``ends_sha256`` of the sorted ids of conversations that end here.
    Without conversations there are no nodes.  ``block_rows``, above 2, does not change them.
    """
    spark = turns.sparkSession
    own = turns.select("conv_id") if members is None else members.select("conv_id")
    zero = F.lit(0).cast("long")
    levels = written(_levels(turns, own.where("conv_id is not null").distinct()), "levels")
    one = F.array
    rows = (
        _ended(levels)
        .join(_paths(levels), "conv_id")
        .select(
            F.col("path.a").alias("a_path"),
            F.col("path.b").alias("b_path"),
            F.col("path.points").alias("points"),
            one("conv_id").alias("conv_ids"),
            one("n_convs").alias("convs"),
            *[one(zero).alias(c) for c in ("children", "leaves", "saved")],
            one("ends_sha256").alias("ends"),
        )
    )
    rows, found = written(rows, "paths"), []
    while True:
        n, prefixes = rows.agg(F.count("*"), F.sum(F.size("a_path"))).first()
        if not n:
            break
        whole = n <= block_rows and (prefixes <= BLOCK_PREFIXES or n <= LEAST_ROWS)
        path = F.arrays_zip("a_path", "b_path")
        dealt = rows.repartition(1) if whole else rows.repartitionByRange(path)
        peeled = written(dealt.sortWithinPartitions(path).mapInArrow(_peeler(whole, block_rows), PEELED), "peeled")
        found.append(peeled.where("depth is not null").select(*NODE))
        if whole:
            break
        rows = peeled.where("depth is null").select(*ROW)
    if not found:
        return spark.createDataFrame([], NODES)
    nodes = reduce(DataFrame.unionByName, found)

    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("a").alias("parent_a"),
        F.col("b").alias("parent_b"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    columns = [f.split()[0] for f in NODES.split(", ")]
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(parents, ["depth", "parent_a", "parent_b"], "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nothing)))
        .select(*columns)
    )


def conversation_trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """The trie of whole conversations; ``columns`` as for ``turn_digests``."""
    return prefix_trie(turn_digests(conversations, **columns))
