import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    # names that operators use inside
    + [T.StructField(n, T.StringType()) for n in ("rid", "key", "part", "bucket", "label", "queue", "shard", "n", "ids", "words")]
)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, repeated rows, copies, near copies, odd characters."""
    rng = random.Random(5)
    base = words(rng, 200)
    near = base.split(" ")
    near[100] = "changed"
    texts = [None, "", " ", "one", base, base, " ".join(near), words(rng, 30000), "A b  c\n\n d\t<|endoftext|> Σας é ﬁ \x1c z", words(rng, 80), "x" * 5000, "!!! ??? ..."]
    rows = [(k * 7 % 13, t, None if k % 3 else "en", None if k % 4 == 0 else f"s{k % 3}", None) for k, t in enumerate(texts)]
    rows += [(None, base, "en", "s1", 1), (None, None, None, None, None), rows[4], rows[4], rows[9]]
    return [(*r, *["x"] * 10) for r in rows]


@pytest.fixture()
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS).repartition(3)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], DOCS)
