import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, digest string, window string, core string"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text[, lang]) rows, with further columns whose names clash with the operators' own."""
    def make(rows):
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), "r", "d", "w", "c") for r in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def sample(spark):
    """The small driver table, rows as (doc_id, text)."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


ODD = [(1, None), (2, ""), (3, "   \n"), (4, "a"), (4, "a"), (None, "a"), (None, "b c"), (7, "word " * 3000), (8, "x" * 5000), (9, "ß ñ \U0001f600 text"), (10, "b\tc")]


@pytest.fixture(scope="session")
def odd(documents):
    return documents(ODD)
