"""Small tables with everything that is odd."""

import random

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

CONVERSATIONS = "conv_id long, turn long, role string, text string"

#: Column names that operators use for results or for themselves.
CLASHING = (
    "size", "target", "copies", "source_size", "shard", "slot", "row", "row_", "before", "bucket", "first", "hits", "score",
    "lang_pred", "fingerprint", "component_id", "keep_id", "group_size", "kept", "n_lines", "n_removed", "runs", "stats",
    "label", "rank", "plan_", "u_", "tie_", "start", "digest_", "length", "prefix", "cut", "certain", "node_",
)


def odd_rows():
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "Épsilon", "zeta", "eta", "theta", "iota", "kappa"]
    prose = lambda n: " ".join(rng.choice(words) + str(rng.randrange(1000)) for _ in range(n))
    long = prose(20_000)
    shared = prose(30)
    lines = "\n".join(prose(4) for _ in range(6))
    return [
        (1, shared + " one tail " + prose(40), "en", "a", 1),
        (2, prose(20) + " " + shared, "en", "a", 2),
        (3, None, None, None, None),
        (4, "", "de", "b", 0),
        (5, " \n\t ", "de", None, 4),
        (6, long, "en", "a", 3),
        (7, long + " end", "en", "b", 3),
        (8, "same text", "fr", "c", 9),
        (9, "same  text", "fr", "c", 10),
        (9, "same  text", "fr", "c", 10),
        (10, "a\na\na\na\na\na", "fr", "c", 11),
        (11, lines, "es", "d", None),
        (12, "head\n" + lines + "\ntail", "es", "d", 5),
        (None, lines + "\nlast", "es", "d", 5),
        (None, None, "en", "a", 5),
        (13, "ÀÉ 你好 😀 words, here; THE " * 12, "en", None, 5),
        (14, "12345 !!! ???", None, "a", 5),
        (14, "another text with the same id", None, "a", 5),
        (15, "ab" * 400, "en", "e", 5),
        (16, "ab" * 300, "en", "e", 5),
        (-7, shared.upper(), "en", "a", 5),
    ]


def odd_turns():
    """Shared beginnings, copies, gaps, ties, null and repeated turns, a long conversation."""
    rng = random.Random(9)
    rows = []
    for conv in [*range(0, 60), 100, 101, 102, 250, 251, 4095, 4096, -3]:
        for turn in range(rng.randrange(5)):
            rows.append((conv, turn * 2, "user" if turn % 2 == 0 else "bot", rng.choice(["hi", "so", "", "你好 😀"])))
    rows += [(300 + i, t, "user", f"same {t}") for i in range(40) for t in range(3)]
    rows += [(500, t, "bot", f"turn {t % 3}") for t in range(300)]
    rows += [(600, None, "user", "first"), (600, -1, None, None), (600, 1, "b", "tie"), (600, 1, "a", "tie"), (600, 1, "a", "tie")]
    return rows + [(None, 0, "user", "hi"), (601, 0, "us", "er"), (602, 0, "u", "ser"), (603, 0, None, "w" * 100_000)]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCUMENTS).repartition(3).cache()


@pytest.fixture(scope="session")
def odd_wide(odd):
    from pyspark.sql import functions as F

    return odd.select("*", *[F.lit(1).alias(c) for c in CLASHING]).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def odd_dir(odd, spark, tmp_path_factory):
    """A folder of tables made of the odd rows."""
    folder = str(tmp_path_factory.mktemp("odd"))
    odd.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(
        [(1, "beta alpha"), (2, "another text with"), (None, "x"), (3, None), (4, "!!"), (5, "same text")],
        "item_id long, text string",
    ).write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(
        [(1, 1, 0), (2, 1, 0), (6, 0, 0), (8, 0, 0), (8, 1, 0), (None, 1, 0), (9, None, None), (99, 0, 1)],
        "doc_id long, quality int, toxic int",
    ).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(
        [(1, "u", None), (2, None, ""), (None, "u", "<p>text"), (3, "u", "<b>" * 3000 + "deep")],
        "page_id long, url string, html string",
    ).write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame(odd_turns(), CONVERSATIONS).write.parquet(f"{folder}/conversations.parquet")
    return folder


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    schemas = {
        "documents": DOCUMENTS,
        "benchmark": "item_id long, text string",
        "labels": "doc_id long, quality int, toxic int",
        "conversations": CONVERSATIONS,
        "pages": "page_id long, url string, html string",
    }
    for name, schema in schemas.items():
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    return folder
