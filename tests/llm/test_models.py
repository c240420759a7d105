"""Language, quality and contamination: held-out accuracy and plain references."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonepipe.llm import decontamination, language, quality
from zonepipe.llm.queries import QUERIES, remainder

SF_DIR = "/root/testdata/sf0.01"


# --- language --------------------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op5_language_id"](spark, SF_DIR).join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 200
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.99
    assert all(0 <= r.score <= 1 for r in rows)


def test_counts_and_scores_equal_plain_sums():
    letters = language.letter_table()
    texts = ["Ab, c", "", "x" * 5, "é 你"]
    model = language.Model(["a", "b"], np.log(np.random.default_rng(0).dirichlet(np.ones(language.BUCKETS), 2)), np.log([0.5, 0.5]))
    names, scores = language.score(texts, model, letters)
    for i, text in enumerate(texts):
        total = model.log_prior.copy()
        for bucket, _ in language.grams([text], letters):
            total += model.log_prob[:, bucket].sum(axis=1)
        p = np.exp(total - total.max())
        expected = (model.languages[int(total.argmax())], (p / p.sum()).max()) if text else ("und", 0.0)
        assert names[i] == expected[0] and scores[i] == pytest.approx(expected[1])


def test_one_long_text_scores_as_a_whole(monkeypatch):
    letters = language.letter_table()
    text = "some words here " * 500
    whole = [b.tolist() for b, _ in language.grams([text], letters)]
    monkeypatch.setattr(language, "CHUNK", 50)
    model = language.Model(["a", "b"], np.log(np.random.default_rng(0).dirichlet(np.ones(language.BUCKETS), 2)), np.log([0.5, 0.5]))
    assert language.score([text, "z"], model, letters)[0][0] == language.score([text], model, letters)[0][0]
    assert len(whole[0]) == sum(c.isalpha() for c in text)


def test_language_of_odd_rows(odd, odd_wide, empty):
    model = language.train(odd)
    assert set(model.languages) == {"en", "de", "fr", "es"}
    rows = language.predict(odd_wide, model)
    assert set(rows.columns) == set(odd_wide.columns)
    for r in rows.collect():
        lettered = r.text is not None and re.search(r"[^\W\d_]", r.text)
        assert (r.lang_pred == "und") == (not lettered)
    assert language.train(empty) is None
    assert {r.lang_pred for r in language.predict(odd, None).collect()} == {"und"}
    assert language.predict(empty, model).collect() == []


# --- quality ---------------------------------------------------------------------------


def test_quality_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = QUERIES["op6_quality"](spark, SF_DIR).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 80
    assert np.mean([r.quality == r.predicted for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_held_out_labels_change_nothing(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    flipped = F.when(remainder("doc_id", 3) == 1, 1 - F.col("quality")).otherwise(F.col("quality"))
    labels.withColumn("quality", flipped.cast("int")).write.parquet(f"{tmp_path}/labels.parquet")
    before = {r.doc_id: r.score for r in QUERIES["op6_quality"](spark, SF_DIR).collect()}
    after = {r.doc_id: r.score for r in QUERIES["op6_quality"](spark, str(tmp_path)).collect()}
    assert before.keys() == after.keys()
    assert max(abs(before[d] - after[d]) for d in before) < 1e-6


def test_isotonic_fit_is_monotone_and_keeps_the_mean():
    rng = np.random.default_rng(0)
    value, weight = rng.random(50) + np.linspace(0, 1, 50), rng.integers(1, 9, 50).astype(float)
    fit = quality.isotonic(value, weight)
    assert (np.diff(fit) >= 0).all()
    assert (fit * weight).sum() == pytest.approx((value * weight).sum())
    assert quality.isotonic(np.array([3.0, 1.0]), np.array([1.0, 1.0])).tolist() == [2.0, 2.0]


def test_quality_without_labels_of_both_kinds(spark, odd, odd_wide, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model, stats = quality.fit(odd, none)
    assert model is None and stats.count() == odd.count()
    kept = quality.accepted(odd_wide, none)
    assert kept.columns == odd_wide.columns and kept.count() == odd.count()
    assert quality.accepted(empty, none).collect() == []


def test_statistics_are_finite():
    classes = quality.byte_classes()
    for text in (None, "", "\n", "x", "a b\nc" * 100_000, "\ud800"):
        vector = quality.statistics(text, classes)
        assert vector.shape == (len(quality.STATISTICS),) and np.isfinite(vector).all()


# --- contamination -----------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_hits(text, items, window):
    words = list(WORD.finditer(fold(text)))
    hit, owners = set(), set()
    for item, body in items:
        own = WORD.findall(fold(body))
        n = min(window, len(own))
        for piece in {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else ():
            for i in range(len(words) - n + 1):
                if tuple(w.group() for w in words[i : i + n]) == piece:
                    hit |= set(range(i, i + n))
                    owners.add(item)
    runs = [i for i in sorted(hit) if i - 1 not in hit]
    spans = []
    for i in runs:
        j = i
        while j + 1 in hit:
            j += 1
        spans.append(tuple(len((text or "")[:p].encode()) for p in (words[i].start(), words[j].end())))
    return len(words), len(hit), sorted(owners), spans


BENCHMARK = [("1", "beta alpha"), ("2", "another text WITH"), ("3", None), ("4", "!!"), ("5", "same-text"), ("6", "你好 😀 words"), ("7", "ab")]


@pytest.mark.parametrize("max_bytes", [1 << 20, 30])
def test_hits_equal_plain_search(spark, odd, odd_wide, max_bytes):
    benchmark = spark.createDataFrame(BENCHMARK, "item_id string, text string")
    found = decontamination.find_contamination(odd_wide, benchmark, window=2, max_bytes=max_bytes)
    assert set(found.columns) == set(odd_wide.columns)
    for r in found.select("text", "hits").collect():
        spans = [(s.start, s.stop) for s in r.hits["spans"]]
        assert (r.hits.n_words, r.hits.n_hit, list(r.hits["items"]), spans) == plain_hits(r.text, BENCHMARK, 2)


def test_any_number_of_automata_needs_one_python_node(spark, odd, monkeypatch):
    benchmark = spark.createDataFrame(BENCHMARK, "item_id string, text string")
    items = [(i, t) for i, t in BENCHMARK if t]
    parts = list(decontamination.pattern_parts(items, 2, 30))
    assert len(parts) == 3 and all(len(p) == 1 or sum(map(len, p)) <= 30 for p in parts)
    assert set().union(*parts) == set(decontamination.patterns(items, 2))
    expected = None
    for max_bytes, held in ((1 << 20, 0), (30, 1), (1, 10**9)):
        monkeypatch.setattr(decontamination, "HELD_CHARACTERS", held)
        found = decontamination.find_contamination(odd.repartition(2), benchmark, window=2, max_bytes=max_bytes)
        rows = sorted(str((r.doc_id, r.text, r.hits)) for r in found.collect())
        plan = found._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
        assert plan.count("ArrowEvalPython") == 1
        assert rows == (expected := expected or rows)


def test_clean_rows_stay_unchanged(spark, odd, empty):
    benchmark = spark.createDataFrame(BENCHMARK, "item_id string, text string")
    clean = decontamination.decontaminated(odd, benchmark, window=2)
    expected = [r for r in odd.collect() if not plain_hits(r.text, BENCHMARK, 2)[1]]
    assert sorted(map(str, clean.collect())) == sorted(map(str, expected))
    assert decontamination.decontaminated(odd, benchmark.limit(0)).count() == odd.count()
    assert decontamination.decontaminated(empty, benchmark).collect() == []


def test_more_languages_than_a_matrix_of_all_buckets_holds(spark):
    """1,100 languages, each with a letter sequence of its own."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda i: "".join(letters[(i // 26**k) % 26] for k in range(3)) * 6
    rows = [(f"l{i:04}", f"{word(i)} {word(i)}") for i in range(1100)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    model = language.train(docs)
    assert len(model.languages) == 1100 and model.log_prob.shape[1] == language.BUCKETS // 2
    some = docs.where("substring(lang, 4, 2) = '07'")
    found = language.predict(some, model).collect()
    assert len(found) == 11 and all(r.lang == r.lang_pred and 0 < r.score <= 1 for r in found)


def test_training_counts_equal_plain_counts(spark, odd):
    model, table = language.train(odd), language.letter_table()
    rows = [(r.lang, r.text) for r in odd.collect() if r.lang is not None and r.text is not None]
    for k, name in enumerate(model.languages):
        counts = np.zeros(language.BUCKETS)
        for _, text in [r for r in rows if r[0] == name]:
            for bucket, _ in language.grams([text], table):
                np.add.at(counts, bucket, 1)
        smooth = counts + language.SMOOTHING
        assert np.allclose(model.log_prob[k], np.log(smooth / smooth.sum()), rtol=1e-12)
        assert np.isclose(model.log_prior[k], np.log(sum(r[0] == name for r in rows) / len(rows)))


def test_buckets_halve_as_languages_double():
    assert [language.buckets_for(n) for n in (1, 1024, 1025, 2049, 10**6)] == [1 << 15, 1 << 15, 1 << 14, 1 << 13, 1 << 10]
