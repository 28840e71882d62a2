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


def prose(seed, words, vocabulary=400):
    draw = random.Random(seed)
    return " ".join(f"w{int(draw.paretovariate(0.6)) % vocabulary}é" for _ in range(words))


def small_corpus():
    """(doc_id, text): prose, copies, near copies, a shared passage, odd white space, empty, null and a very long text."""
    shared = prose("shared", 60)
    rows = [(n, prose(n, 30 + 7 * n)) for n in range(30)]
    rows += [(30 + n, f"{prose(n, 20)}\n{shared} {prose(-n - 1, 45)}") for n in range(10)]
    rows += [(40 + n, prose("copy", 120)) for n in range(8)]
    rows += [(50 + n, " ".join([*prose("copy", 120).split()[: 118 - n % 3], f"End{n}", "over"])) for n in range(8)]
    rows += [(60, ""), (61, None), (62, " \t\n"), (63, "one two"), (64, "One TWO  three\n"), (65, "one two")]
    rows += [(66, prose("long", 30_000)), (67, "a " * 500), (68, prose(3, 51)), (68, prose(3, 51)), (None, "no id here")]
    return rows


@pytest.fixture(scope="session")
def corpus():
    return small_corpus()


@pytest.fixture(scope="session")
def documents(spark, corpus):
    """The corpus as a table of several partitions."""
    rows = [(i, t, "en", f"src{n % 3}", None if t is None else len(t)) for n, (i, t) in enumerate(corpus)]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3).persist()


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
