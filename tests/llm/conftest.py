import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use for columns of their own
        T.StructField("size", T.StringType()),
        T.StructField("Score", T.StringType()),
        T.StructField("words", T.StringType()),
        T.StructField("key", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) or (id, text, source), with extra columns of clashing names."""

    def made(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or ""), "s", "x", None, "k") for r in rows]
        return spark.createDataFrame(full, DOCS)

    return made


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def prose():
    """Distinct words that no two texts share by chance."""

    def words(seed, n):
        return " ".join(f"w{(seed * 7919 + i * 104729) % 1000003}x" for i in range(n))

    return words
