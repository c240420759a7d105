"""The pipeline: every stage against what it has to do, on real, odd and empty tables."""

import corpus_pipeline
from zonepipe.llm import decontamination
from tests.llm.test_dedup import plain_components, plain_fingerprint

SF_DIR = "/root/testdata/sf0.001"


def test_stages_on_real_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert len(corpus_pipeline.STAGES) == 5

    good = stages["quality"](spark, docs, SF_DIR).cache()
    kept = {r.doc_id for r in good.collect()}
    right = [(d in kept) == bool(q) for d, q in labels.items()]
    assert sum(right) / len(right) > 0.9 and good.columns == docs.columns

    rows = good.collect()
    single = stages["near_dedup"](spark, good, SF_DIR).cache()
    parts = plain_components([plain_fingerprint(r.text) for r in rows])
    least = {}
    for r, p in zip(rows, parts):
        least[p] = min(r.doc_id, least.get(p, r.doc_id))
    assert sorted(r.doc_id for r in single.collect()) == sorted(least.values())
    assert single.columns == docs.columns

    clean = stages["decontamination"](spark, single, SF_DIR).cache()
    windows = decontamination.patterns([(str(r.item_id), r.text) for r in benchmark.collect()])
    dirty = lambda t: any(w in b" " + b" ".join(decontamination.folded(t).split()) + b" " for w in windows)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in single.collect() if not dirty(r.text))

    mixed = stages["mixing"](spark, clean, SF_DIR).cache()
    assert mixed.columns == docs.columns
    words = lambda df: sum(len((r.text or "").split()) for r in df.collect())
    assert 1.3 < words(mixed) / words(clean) < 1.7

    sharded = stages["sharding"](spark, mixed, SF_DIR)
    assert sharded.columns == [*docs.columns, "shard", "slot"]
    rows = sharded.collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in mixed.collect())
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)


def test_stages_keep_every_column_of_odd_rows(spark, odd_wide, odd_dir):
    rows = {tuple(r) for r in odd_wide.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, odd_wide, odd_dir)
        assert kept.columns == odd_wide.columns, name
        assert {tuple(r) for r in kept.collect()} <= rows, name
    sharded = corpus_pipeline.STAGES[-1][1](spark, odd_wide, odd_dir)
    assert set(sharded.columns) == set(odd_wide.columns) and sharded.count() == odd_wide.count()


def test_run_equals_stages_in_turn(spark, odd_dir, empty_dir):
    rows = corpus_pipeline.run(spark, odd_dir)
    assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    assert rows.count() > 0
    assert corpus_pipeline.run(spark, empty_dir).collect() == []
