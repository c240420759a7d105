"""The prefix trie against plain dictionaries of sequences."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from zonepipe.llm import prefix_trie
from zonepipe.llm.queries import op12_prefix_trie

COLUMNS = [c.split()[0] for c in prefix_trie.NODES.split(", ")]


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def plain_conversations(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    return {c: [t[3:] for t in sorted(turns)] for c, turns in convs.items()}


def plain_rebuilt(convs):
    found = {}
    for c, turns in convs.items():
        head = zlib.crc32(str(c).encode()) % 6
        family = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        found[c] = convs.get(family, [])[:head] + turns[head:]
    return found


def plain_trie(convs):
    members, below = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for node in members:
        if node:
            below.setdefault(node[:-1], []).append(node)
    figures = {}
    for node in sorted(members, key=len, reverse=True):
        children = below.get(node, [])
        leaves = sum(figures[k][0] for k in children) or 1
        saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        figures[node] = (leaves, saved + sum(figures[k][1] for k in children), len(children))
    rows = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in ids if len(convs[c]) == len(node)))
        leaves, saved, children = figures[node]
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(ids), len(node), parent, len(ids), children, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def odd_rows(spark, odd_dir):
    return [tuple(r) for r in spark.read.parquet(f"{odd_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]


def test_query_on_odd_rows(spark, odd_dir):
    expected = plain_trie(plain_rebuilt(plain_conversations(odd_rows(spark, odd_dir))))
    assert rows_of(op12_prefix_trie(spark, odd_dir)) == expected
    assert max(r[1] for r in expected) == 300


@pytest.mark.parametrize("block_rows", [3, 7, 2048])
def test_blocks_do_not_change_nodes(spark, odd_dir, block_rows):
    rows = odd_rows(spark, odd_dir)
    turns = prefix_trie.turn_digests(spark.read.parquet(f"{odd_dir}/conversations.parquet"))
    assert rows_of(prefix_trie.prefix_trie(turns, block_rows=block_rows)) == plain_trie(plain_conversations(rows))


def test_real_conversations_in_small_blocks(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    found = prefix_trie.prefix_trie(prefix_trie.turn_digests(table), block_rows=8)
    assert rows_of(found) == plain_trie(plain_conversations(rows))


def test_a_beginning_shared_by_all_is_handed_on_in_few_rows(spark):
    n = 5000
    turns = [(c, t, "user", "hi" if t == 0 else f"{c} {t}") for c in range(n) for t in range(2)]
    rows = rows_of(prefix_trie.conversation_trie(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")))
    assert len(rows) == 2 + n
    assert [r[3:7] for r in rows if r[1] == 0] == [(n, 1, n, (n - 1) * 2)]
    assert [r[3:7] for r in rows if r[1] == 1] == [(n, n, n, (n - 1) * 2)]


def test_turnless_members_and_other_columns(spark):
    turns = spark.createDataFrame([(5, 0, "u", "x", 1, "y")], "conv_id long, turn long, role string, text string, depth int, path string")
    members = spark.createDataFrame([(5,), (4,), (None,)], "conv_id long")
    rows = rows_of(prefix_trie.prefix_trie(prefix_trie.turn_digests(turns), members))
    assert rows == plain_trie({5: [("u", "x")], 4: []})
    renamed = turns.select(F.col("conv_id").alias("chat"), F.col("turn").alias("at"), F.col("role").alias("who"), F.col("text").alias("said"))
    again = prefix_trie.conversation_trie(renamed, conv_col="chat", turn_col="at", role_col="who", text_col="said")
    assert rows_of(again) == plain_trie({5: [("u", "x")]})
