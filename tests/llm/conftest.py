"""Small hand-made corpora for the corpus operators: edge cases, planted copies, passages and benchmark items."""

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: Names that the operators use inside; none may clash with a column of the input.
CLASHES = ["id", "key", "th", "fp", "hits", "found", "n_words", "n_removed", "items", "bucket", "size", "g", "low", "toxic", "c0", "d1", "slot", "repeats", "benchmark_hits", "quality_scores", "chunk"]


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgeiouß") for _ in range(rng.randint(2, 7))) for _ in range(n))


def corpus(seed: int = 5) -> list[tuple]:
    rng = random.Random(seed)
    texts = [words(rng, rng.randint(1, 120)) for _ in range(60)]
    passage, line = words(rng, 60), "Und Und Und Und Und Und Und Und Und Und Und Und Und Und Und"
    texts[10] = texts[3]                                        # exact copies
    texts[11:16] = [texts[4]] * 5
    texts[20] = texts[5] + " tail"                               # near copy
    for i in (21, 25, 33):
        texts[i] = words(rng, 20) + "\n" + passage + "\t" + words(rng, 10)
    for i in (40, 41):
        texts[i] = line + "\n" + words(rng, 3) + " " + line
    texts += [None, "", "   \n\t ", "one", "a b", "é", "." * 500, "x" * 5000, "W " * 700, words(rng, 9000), "\n\n\n", "a\n\n\nb.\n"]
    rows = [(i, t, ["en", "de", None][i % 3], f"src{i % 4}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[2], rows[2]]                                   # repeated rows
    rows += [(None, texts[6], "en", None, 1), (None, None, None, None, None), (7, "another text under an id that is used", "en", "src0", 5)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    from plumeline.llm.runtime import with_package
    return with_package(spark).createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def wide(docs):
    """The corpus with extra columns under names the operators use inside."""
    from pyspark.sql import functions as F
    return docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])


@pytest.fixture(scope="session")
def empty(spark, docs):
    return spark.createDataFrame([], DOCS)
