import pytest

EDGES = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, "a"), (4, "one", "en", None), (5, "two words", "en", "b"),
    (6, "word " * 4000, "en", "a"), (7, "x" * 20000, "fr", "a"), (8, "two words", "en", "b"), (9, "Ünï códe — 漢字 🙂\n\nline\nline", "de", "b"), (9, "Ünï códe — 漢字 🙂\n\nline\nline", "de", "b"),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns with names that the operators use themselves."""
    df = spark.createDataFrame(EDGES, "doc_id long, text string, lang string, source string")
    return df.selectExpr("*", "1 as n", "'x' as hash", "'y' as stratum", "2 as a", "3 as bucket", "'z' as `dotted.name`", "4 as n_words", "5 as shard")


@pytest.fixture(scope="session")
def empty(edges):
    return edges.limit(0)
