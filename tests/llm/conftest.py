import pytest

LONG = "word and more words " * 12_000


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in any column, empty and very long texts, repeated rows and ids, and further columns with clashing names."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "en", 7, 0.5),
        (2, "the quick brown fox jumps over the lazy dog", "en", 8, 0.5),
        (2, "the quick brown fox jumps over the lazy dog", "en", 8, 0.5),
        (3, None, None, None, None), (4, "", "en", 0, 0.1), (5, "   \n\t ", "en", 0, 0.1),
        (None, "only a few words", "en", 1, 0.2), (6, LONG, "en", 1, 0.3), (7, "one", "en", 1, 0.3),
        (8, "Ünïcödé ▁ words 日本語 😀 here", "de", 1, 0.3), (9, "mail a.b@c.com +1 (212) 555-0199 10.1.2.3", None, 1, 0.3),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score long, label double").withColumnsRenamed({})


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)


@pytest.fixture(scope="session")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")
