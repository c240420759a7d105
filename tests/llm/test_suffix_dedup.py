import random

import numpy as np
import pandas as pd

from zonepipe.llm import suffix_dedup as sd


def brute(rows):
    """``{row number: (n_bytes, spans, kept)}`` by a set of all strings of smaller ids."""
    out, seen = {}, set()
    keyed = sorted(enumerate(rows), key=lambda r: (r[1][0] is not None, r[1][0] or 0))
    i = 0
    while i < len(keyed):
        same = [k for k in keyed[i:] if k[1][0] == keyed[i][1][0]]
        for number, (_, text) in same:
            data = (text or "").encode()
            gone = bytearray(len(data))
            for s in range(len(data) - 49):
                if data[s : s + 50] in seen:
                    gone[s : s + 50] = b"\1" * 50
            edges = np.flatnonzero(np.diff(np.concatenate(([0], np.frombuffer(bytes(gone), np.uint8).astype(int), [0]))))
            out[number] = (len(data), edges.reshape(-1, 2).tolist(), bytes(b for b, g in zip(data, gone) if not g))
        for _, (_, text) in same:
            data = (text or "").encode()
            seen.update(data[s : s + 50] for s in range(len(data) - 49))
        i += len(same)
    return out


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(
        (str(r.doc_id), r.n_bytes, [[s.start, s.stop] for s in r.spans], bytes(r.kept))
        for r in sd.remove_repeats(df, **options).collect()
    )
    expected = brute(rows)
    assert got == sorted((str(rows[i][0]), n, spans, kept) for i, (n, spans, kept) in expected.items())
    for n, spans, kept in expected.values():
        assert n - sum(b - a for a, b in spans) == len(kept)


def test_odd_rows(spark, odd):
    check(spark, [(r.doc_id, r.text) for r in odd.collect()])


def test_random_overlaps_over_several_batches(spark):
    rng = random.Random(1)
    base = ["".join(rng.choice("abc dé") for _ in range(rng.randrange(60, 400))) for _ in range(12)]
    rows = []
    for i in range(120):
        pieces = []
        for _ in range(rng.randrange(1, 5)):
            b = rng.choice(base)
            a = rng.randrange(len(b))
            pieces.append(b[a : a + rng.randrange(20, 200)])
        rows.append((i // 2 if i % 7 == 0 else i + 100, "".join(pieces)))
    check(spark, rows, batch_bytes=4000)


def test_exactly_fifty_bytes(spark):
    text = "".join(chr(97 + i % 26) + str(i) for i in range(40))[:50]
    check(spark, [(1, "x" + text + "y"), (2, "z" + text), (3, text[:49]), (4, text + text[:49])])


def test_low_complexity_and_hot_grams(spark):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("xyz") for _ in range(i)) + "the " * (10 + i) + "".join(rng.choice("uvw") for _ in range(60))) for i in range(40)]
    check(spark, rows)
    # All in one batch: hot grams are found before anything is sent.
    check(spark, rows, hot_contexts=3)
    # Few in each batch: a shard that finds a hot gram asks for its strings.
    check(spark, rows, hot_contexts=3, batch_bytes=300)


def test_contexts_of_a_gram_are_counted_and_hot_ones_become_strings():
    rng = random.Random(5)
    passage = "the very same passage that every document holds"
    texts = ["".join(rng.choice("abcdefgh") for _ in range(90)) + passage + "".join(rng.choice("abcdefgh") for _ in range(90)) for _ in range(20)]
    batch = pd.DataFrame({"batch": 0, "body": [t.encode() for t in texts]})
    counts = sd.count_contexts(batch)
    assert counts["n"].max() == 20
    hot = np.sort(counts.loc[counts["n"] == 20, "gram"].to_numpy().view(np.uint64))
    data = np.frombuffer(texts[0].encode(), np.uint8)
    start, stop, at, gram, context, _ = sd.Entries(hot).of(data)
    assert not np.isin(gram, hot).any()
    # Every 50-byte string still lies in an entry.
    inside = np.zeros(len(data), bool)
    for a, b in zip(start, stop):
        inside[a : b - sd.LENGTH + 1] = True
    assert inside[: len(data) - sd.LENGTH + 1].all()


def test_padding_is_told_from_nul_bytes():
    parts = np.zeros((3, sd.LENGTH), np.uint8)
    parts[:, :5] = 7
    got = sd._agreement(parts, np.array([sd.LENGTH, 5, sd.LENGTH]), np.zeros(3, np.int64))
    assert got.tolist() == [sd.LENGTH, 5, sd.LENGTH]


def test_blind_trie_orders_strings():
    rng = random.Random(3)
    strings = [bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(300)]
    trie = sd.BlindTrie()
    classes = [trie.insert(s) for s in strings]
    assert [trie.strings[c] for c in trie.ordered()] == sorted(set(strings))
    assert all(trie.strings[c] == s for c, s in zip(classes, strings))


def test_string_classes_sort_by_key_then_bytes():
    rng = np.random.default_rng(4)
    strings = rng.integers(97, 99, (400, 20)).astype(np.uint8)
    strings[:, :14] = 97
    key = rng.integers(0, 3, 400)
    label = sd.string_classes(strings, key)
    pairs = [(int(k), s.tobytes()) for k, s in zip(key, strings)]
    rank = {p: i for i, p in enumerate(sorted(set(pairs)))}
    assert label.tolist() == [rank[p] for p in pairs]
