import pytest

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, `TEXT` int, size string, rank string"
LONG = "the quick brown fox jumps, 12 over " * 3000


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    rows = [
        (1, "Hello World, mail a.b@c.org now", "en", "a", 3, 1, "x", "y"),
        (1, "Hello World, mail a.b@c.org now", "en", "a", 3, 1, "x", "y"),
        (2, None, None, None, None, None, None, None),
        (None, "some text of no id", "de", None, 1, None, None, None),
        (None, None, None, "a", None, None, None, None),
        (3, "", "fr", "b", 0, 2, "", ""),
        (4, " \n\t ", "fr", "b", 4, 2, "", ""),
        (5, LONG, "en", "Z", len(LONG), 2, "", ""),
        (6, LONG, "en", "é", len(LONG), 2, "", ""),
        (7, "one", "de", "b", 3, 2, "", ""),
        (8, "a <|endoftext|> b <|ENDOFTEXT|> İstanbul ΟΔΟΣ. é. …. 'S it's 𝒳", "es", "b", 3, 2, "", ""),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
