import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) pairs, with further columns whose names could clash."""
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
         T.StructField("n_chars", T.LongType()), T.StructField("node", T.StringType()), T.StructField("row", T.StringType()), T.StructField("h", T.LongType())]
    )

    def make(*pairs):
        rows = [(i, t, "en", "s", None if t is None else len(t), "x", "y", 7) for i, t in pairs]
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture(scope="session")
def words():
    import random

    def make(n, seed):
        r = random.Random(seed)
        return [f"w{r.randrange(5000)}" for _ in range(n)]

    return make
