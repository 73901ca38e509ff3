import pytest
from pyspark.sql import types as T

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

DOC_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                           T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                           # names that the operators use themselves
                           T.StructField("size", T.StringType()), T.StructField("rate", T.StringType()), T.StructField("row", T.StringType()),
                           T.StructField("n", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("kept", T.StringType()), T.StructField("key", T.StringType())])


def sentence(start: int, n: int) -> str:
    return " ".join(f"w{(start * 7919 + i * i * 31 + i) % 9973}" for i in range(n))


def rows():
    long = sentence(3, 9000)
    base = sentence(1, 200)
    out = [(0, base, "en", "a"), (1, base, "en", "a"), (2, base.replace("w", "W", 3), "en", "b"), (3, base + " tail words here", "en", "b"), (4, None, "en", "a"), (5, "", "en", "a"),
           (6, " \n\t ", "de", None), (7, "short text", "de", None), (8, "short text", None, "c"), (9, long, "en", "c"), (10, long + " more", "en", "c"), (11, sentence(5, 60), None, None),
           (12, "a\nb\nb\n\na a a a a a a", "fr", "c"), (13, "1234 5678", "fr", "d"), (14, "İstanbul Σας naïve café <|endoftext|> it's", "fr", "d"), (None, base, "en", "a"), (None, None, None, None)]
    out += [(20 + i, sentence(100 + i, 80 + i), "en", "a") for i in range(12)] + [(0, base, "en", "a")]
    return [(i, t, lang, s, None if t is None else len(t), "x", "y", "z", "n", "s", "k", "q") for i, t, lang, s in out]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), DOC_SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
