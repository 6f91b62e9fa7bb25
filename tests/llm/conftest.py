import random

import pytest
from pyspark.sql import types as T

from granary.llm.tables import prepared as ready

SF_SMALL, SF_MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.1"


@pytest.fixture(scope="session")
def spark(spark):
    return ready(spark)


#: documents with an extra column whose name clashes with what operators return.
DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("score", T.StringType()),
        T.StructField("piece", T.StringType()),
        T.StructField("component_id", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("start", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


def words(seed, n, vocabulary=400):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}x" for _ in range(n))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and white texts, a very long text, ties, repeated rows, clashing columns."""
    long = words(1, 60_000, 3000)
    plain = words(2, 80)
    texts = [(1, None), (2, ""), (3, "  \n\t "), (4, long), (5, plain), (6, plain), (6, plain), (None, words(3, 50)), (None, None), (7, "é" * 3000), (8, "a"), (9, "one two three four")]
    rows = [(i, t, None if k % 3 else "en", None, None if t is None else len(t), None, "x", None, None, None, None) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
