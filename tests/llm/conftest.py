import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
# Extra columns whose names the operators use or return themselves.
CLASHING = ["size", "row", "copies", "node", "key", "kept", "language", "shard", "part", "id", "hash", "of", "words"]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, lang, source), with clashing columns if asked for."""

    def make(rows, clash=True):
        values = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
        df = spark.createDataFrame(values, DOCS).repartition(3)
        if clash:
            for name in CLASHING:
                df = df.selectExpr("*", f"cast(null as string) as {name}")
        return df

    return make


PROSE = (
    "the old mill by the river turned slowly while children watched the water fall and the miller carried "
    "sacks of flour up the narrow stair to the loft where swallows had built their nests under the beams"
)


def sentence(seed, n):
    """Different words for different seeds."""
    return " ".join(f"w{seed}x{i * 7919 % 1000}" for i in range(n))


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """NULLs in any column, empty and blank texts, repeated rows and ids, a long text, ties."""
    rows = [
        (1, PROSE, "en", "a"),
        (2, PROSE, "en", "a"),
        (2, PROSE, "en", "a"),
        (2, PROSE + " again", "en", None),
        (3, None, "en", "b"),
        (4, "", None, "b"),
        (5, " \t\n ", "en", "b"),
        (None, "a text without an id", "en", "b"),
        (None, None, None, None),
        (6, "short text", None, None),
        (7, sentence(7, 30_000), "en", "c"),
        (8, "x" * 50_000, "en", "c"),
        (9, "é\u0085ü — ½\x1c ß 日本語 \x0b\x0c end", "de", "c"),
        (10, "12 34 .. !!", "en", "c"),
    ]
    return make_docs(rows)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
