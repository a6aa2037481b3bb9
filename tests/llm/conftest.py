import pytest

SF_SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, shard int"


@pytest.fixture(scope="session")
def awkward(spark):
    """Rows with nulls in every column, empty, blank and very long texts, repeated
    rows, ties of ids, and extra columns whose names clash with results."""
    long_text = " ".join(f"word{i % 977} item{i % 13}" for i in range(60_000))
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta\nsecond line here", "en", "a", 10, 0.5, 3),
        (1, "alpha beta gamma delta epsilon zeta eta theta\nsecond line here", "en", "a", 10, 0.5, 3),
        (2, "alpha beta gamma delta epsilon zeta eta theta\nsecond line here", "en", "b", 10, None, None),
        (3, None, "en", "a", None, None, None),
        (4, "", None, None, 0, None, None),
        (5, " \t\n ", "de", "", 4, None, None),
        (6, long_text, "en", "a", len(long_text), None, None),
        (6, "another text under the same id, quite different", None, "b", 5, None, None),
        (None, "a text without an id", "fr", None, 5, None, None),
        (7, "12345 67890 !!!", "en", "c", 5, None, None),
        (8, "x", "en", "c", 1, None, None),
        (9, "été \U0001F600 中文 ß " * 3, "fr", "c", 5, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def small_labels(spark):
    return spark.read.parquet(f"{SF_SMALL}/labels.parquet")
