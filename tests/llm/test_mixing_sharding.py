"""Mixing and sharding: laws, edge cases, and a plain reference for the targets."""

import zlib

import pytest
from pyspark.sql import functions as F

from tests.compare import spark_rows
from zonepipe.llm import mixing, sharding
from zonepipe.llm.queries import MIX_MOST, MIX_SHARE, MIX_WEIGHTS, QUERIES

SF_DIR = "/root/testdata/sf0.01"


def plain_targets(sizes, weights, share, most):
    """By rounds: targets above their cap stop there, the rest is shared again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        if not free:
            return fixed
        left = total - sum(fixed.values())
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > most * sizes[s]]
        if not over:
            return fixed | {s: level * weight[s] for s in free}
        fixed |= {s: most * sizes[s] for s in over}


def check_mix(df, **options):
    rows = mixing.mix(df, MIX_WEIGHTS, MIX_SHARE, MIX_MOST, **options).collect()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    targets = plain_targets(sizes, MIX_WEIGHTS, MIX_SHARE, MIX_MOST)
    largest = max((r.size for r in rows), default=0)
    for source, size in sizes.items():
        own = [r for r in rows if r.source == source]
        assert {r.source_size for r in own} == {size}
        assert all(r.target == pytest.approx(targets[source]) for r in own)
        assert abs(sum(r.copies * r.size for r in own) - targets[source]) <= largest
        assert max(r.copies for r in own) - min(r.copies for r in own) <= 1
        assert all(0 <= r.copies <= MIX_MOST for r in own)
    return rows


def test_mix_of_real_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = check_mix(docs)
    again = mixing.mix(docs.repartition(7), MIX_WEIGHTS, MIX_SHARE, MIX_MOST).collect()
    assert sorted((r.doc_id, r.copies) for r in rows) == sorted((r.doc_id, r.copies) for r in again)


def test_targets_of_sources_that_reach_their_caps_together(spark):
    sizes = {f"s{i}": 10 for i in range(7)} | {"t": 3, "u": 3}
    for weights, share in (((1,), 0.5), ((5, 2, 1), 1.5), ((1,), 1.9)):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.source_targets(df, weights, share, 2.0).collect()}
        assert got == pytest.approx(plain_targets(sizes, weights, share, 2.0))


def test_mix_of_odd_rows(odd, odd_wide):
    assert len(check_mix(odd)) == odd.count()
    assert set(mixing.mix(odd_wide, MIX_WEIGHTS, MIX_SHARE).columns) == set(odd_wide.columns)
    check_mix(odd_wide)


def test_mix_with_sources_too_many_to_broadcast(odd, monkeypatch):
    expected = sorted(str((r.doc_id, r.copies)) for r in check_mix(odd))
    monkeypatch.setattr("zonepipe.llm.common.BROADCAST_ROWS", -1)
    assert sorted(str((r.doc_id, r.copies)) for r in check_mix(odd)) == expected


def test_border_inside_one_bucket(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 5), "ab"[i % 3 == 0]) for i in range(300)], "doc_id long, text string, source string")
    expected = sorted((r.doc_id, r.copies) for r in check_mix(docs))
    monkeypatch.setattr(mixing, "RANK_BUCKETS", 2)
    assert sorted((r.doc_id, r.copies) for r in check_mix(docs)) == expected


def test_border_cut_again_until_it_is_small(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("source", F.lit("one"))
    expected = sorted((r.doc_id, r.copies) for r in mixing.mix(docs, (1,), 0.4).collect())
    monkeypatch.setattr(mixing, "RANK_BUCKETS", 4)
    monkeypatch.setattr(mixing, "BORDER_ROWS", 2)
    assert sorted((r.doc_id, r.copies) for r in mixing.mix(docs, (1,), 0.4).collect()) == expected


@pytest.mark.parametrize("share, certain", [(0.25, 0), (1.5, 1)])
def test_frequencies_match_inclusion_odds(spark, share, certain):
    """Sources alike in all but their ids are as many draws of one sample.

    Pareto's probabilities are asymptotic: one document must not hold much of a sample.
    """
    n, lengths = 300, [*range(1, 21)] * 4 + [60, 60]
    rows = [(s * 100 + i, "w " * k, f"s{s}") for s in range(n) for i, k in enumerate(lengths)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, (1,), share).groupBy("size").agg(F.avg("copies").alias("mean")).collect()
    rest = (share - certain) * sum(lengths)
    low, high = 0.0, 1.0
    for _ in range(100):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(1, level * k) * k for k in lengths) < rest else (low, level)
    odds = {k: min(1, level * k) for k in lengths}
    assert max(odds.values()) > 5 * min(odds.values())
    for r in got:
        assert r["mean"] == pytest.approx(certain + odds[r["size"]], abs=0.1)


@pytest.mark.parametrize("few", [200_000, -1])
def test_rows_without_or_with_one_id_are_drawn_apart(spark, monkeypatch, few):
    monkeypatch.setattr("zonepipe.llm.common.BROADCAST_ROWS", few)
    rows = [(None if i < 60 else 7, f"t{i % 40} w w w", "a") for i in range(120)] + [(8, "x y", "b"), (9, "x", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    options = ((1, 1), 0.5)
    got = mixing.mix(docs, *options).collect()
    taken = sum(r.copies * r.size for r in got if r.source == "a")
    [target] = {r.target for r in got if r.source == "a"}
    assert len(got) == len(rows) and 0 < target < 480 and abs(taken - target) <= 4
    again = mixing.mix(docs.repartition(5), *options).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_of_an_empty_table_and_of_no_words(spark, empty):
    assert mixing.mix(empty, MIX_WEIGHTS, MIX_SHARE).collect() == []
    blank = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert [r.copies for r in mixing.mix(blank, MIX_WEIGHTS, MIX_SHARE).collect()] == [0, 0]


def check_shards(rows, n_shards):
    """Contiguous shards with gapless slots, each row where its middle byte falls."""
    total = sum(r.size for r in rows)
    rows = sorted(rows, key=lambda r: (r.shard, r.slot))
    at, slots = 0, {}
    for r in rows:
        assert r.shard == min(n_shards - 1, (2 * at + r.size) * n_shards // (2 * total))
        assert r.slot == slots.get(r.shard, 0)
        slots[r.shard] = r.slot + 1
        at += r.size
    ids = [(r.doc_id is not None, r.doc_id or 0) for r in rows]
    assert ids == sorted(ids)


def test_shards_of_real_documents(spark):
    rows = QUERIES["op3_sharding"](spark, SF_DIR).collect()
    check_shards(rows, 24)
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {d: (len(t) + 8, zlib.crc32(t)) for d, t in texts.items()}
    loads = {}
    for r in rows:
        loads[r.shard] = loads.get(r.shard, 0) + r.size
    mean = sum(loads.values()) / 24
    assert max(abs(x - mean) for x in loads.values()) <= max(r.size for r in rows)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}


def test_shards_of_odd_rows_keep_columns(odd_wide):
    sharded = sharding.shard_by_bytes(odd_wide, 4, F.octet_length(F.coalesce("text", F.lit(""))) + 8, buckets=3)
    assert set(sharded.columns) == set(odd_wide.columns)
    rows = sharded.withColumn("size", (F.octet_length(F.coalesce("text", F.lit(""))) + 8).cast("long")).collect()
    check_shards(rows, 4)
    assert len(rows) == odd_wide.count()


def test_hot_and_null_ids_are_spread(spark):
    rows = [(5, f"t{i}") for i in range(400)] + [(None, f"n{i}") for i in range(300)] + [(i, "x") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard_by_bytes(df, 7, F.length("text") + 1, buckets=16)
    check_shards(got.withColumn("size", (F.length("text") + 1).cast("long")).collect(), 7)


def test_more_shards_than_rows_and_no_rows(spark, empty):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    got = sharding.shard_by_bytes(df, 9, F.lit(10))
    check_shards(got.withColumn("size", F.lit(10)).collect(), 9)
    assert sharding.shard_by_bytes(empty, 9, F.lit(10)).collect() == []
    names, rows = spark_rows(sharding.shard_by_bytes(df, 2, F.lit(0)))
    assert [r[names.index("shard")] for r in rows] == [0, 0]
