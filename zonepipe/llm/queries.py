"""The operators as queries over whole tables, and the SQL that states their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepipe.llm import (
    decontamination,
    exact_dedup,
    html_text,
    language,
    lexical_search,
    line_dedup,
    mixing,
    prefix_trie,
    quality,
    quality_rules,
    sharding,
    simhash,
    suffix_dedup,
)
from zonepipe.llm.common import table, text_or_empty, written

Query = Callable[[SparkSession, str], DataFrame]

N_SHARDS = 24
MIX_WEIGHTS = (5, 2, 1)
MIX_SHARE = 1.5
MIX_MOST = 2.0
MIX_SEED = "mix"
# A conversation begins with fewer turns than FAMILY_TURNS of the first one of its FAMILY ids.
FAMILY = 100
FAMILY_TURNS = 6


def remainder(id_col: str, divisor: int) -> Column:
    """Of the id's CRC-32 as text; a null id has none, and is neither held out nor learned from."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(divisor))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document under a 50-byte string of an earlier document, and what is left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page."""
    return html_text.extract_text(table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", "text")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 23 of near equal bytes, contiguous in doc_id order."""
    text = text_or_empty("text")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return sharding.shard_by_bytes(docs, N_SHARDS, F.col("size")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the components they form."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.components(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder("doc_id", 4) == 2
    model = language.train(docs.where(~held_out))
    return language.predict(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from labelled ones that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = remainder("doc_id", 3) == 1
    model, stats = quality.fit(docs.select("doc_id", "text"), labels, ~held_out)
    scored = stats.withColumn("score", quality.probability(F.col("stats"), model))
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of three-line windows that occurred before."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.without_repeats(docs).select("doc_id", "n_lines", "n_removed", "text")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs, MIX_WEIGHTS, MIX_SHARE, MIX_MOST, MIX_SEED)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies, white space aside, and the row of each group that stays."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.sha2(exact_dedup.normalised("text"), 256).alias("text_sha256")
    )
    return exact_dedup.exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark"), spans=False)
    return hits.select(
        "doc_id",
        "hits.n_words",
        "hits.n_hit",
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hits.items"), 256).alias("items_sha256"),
        (F.col("hits.n_hit") > 0).alias("contaminated"),
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that match each benchmark item best."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return lexical_search.search(docs.select("doc_id", "text"), items.select("item_id", "text"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversations that begin with the first turns of their family's first one.

    Positions of the own turns that stay are above those of the turns they follow.
    """
    ids = turns.select("conv_id").distinct()
    head = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(FAMILY_TURNS))
    first = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < FAMILY_TURNS))
    shared = (
        ids.withColumns({"family": F.col("conv_id") - F.col("conv_id") % FAMILY, "head": head})
        .join(first.withColumnRenamed("conv_id", "family"), "family")
        .where(F.col("pos") <= F.col("head"))
    )
    return shared.select(*turns.columns).unionByName(turns.where(F.col("pos") > head))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of rebuilt conversations."""
    turns = written(prefix_trie.turn_digests(table(spark, sf_dir, "conversations")), "turns")
    return prefix_trie.prefix_trie(rebuilt(turns), members=turns)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, and what fixed rules and the learned decision list say of it."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    rules, stats = quality_rules.fit(docs, labels)
    counts = {c: F.col("stats")[c] for c in quality_rules.BASE}
    base_failed = (counts["n_words"] < 50) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])
    return stats.select(
        "doc_id",
        *[count.alias(c) for c, count in counts.items()],
        base_failed.alias("base_failed"),
        (~base_failed & quality_rules.verdict(rules, F.col("stats"))).alias("kept"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_html_text,
        op3_sharding,
        op4_simhash,
        op5_language_id,
        op6_quality,
        op7_line_dedup,
        op8_mixing,
        op9_exact_dedup,
        op10_decontamination,
        op11_lexical_search,
        op12_prefix_trie,
        op13_quality_rules,
    )
}
