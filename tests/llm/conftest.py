import pytest
from pyspark.sql import types as T

TEXTS = "doc_id long, text string"


@pytest.fixture(scope="session")
def docs(spark):
    def make(*texts, ids=None):
        rows = list(zip(ids or range(len(texts)), texts, strict=True))
        return spark.createDataFrame(rows, TEXTS)

    return make


@pytest.fixture(scope="session")
def crowded(spark):
    """Rows with nulls, ties, repeats and extra columns whose names operators use inside."""
    names = ["id", "row", "h", "norm", "keep_id", "group_size", "candidates", "spans", "component", "salt", "nth", "key", "start", "length", "kept"]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()), *[T.StructField(n, T.StringType()) for n in names]])
    long = " ".join(f"word{k % 977}" for k in range(30_000))
    rows = [(1, "same text here"), (2, "same  text\there"), (2, "same  text\there"), (3, None), (4, ""), (None, "only text"), (None, "same text here"), (5, long), (6, " \n"), (7, "a@b.co and 4111 1111 1111 1111")]
    filler = ["x"] * len(names)
    return spark.createDataFrame([(i, t, None if k % 3 == 0 else f"s{k % 2}", *filler) for k, (i, t) in enumerate(rows)], schema)


@pytest.fixture(scope="session")
def no_rows(crowded):
    return crowded.limit(0)
