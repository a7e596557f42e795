import public_tokenizers
import pytest


@pytest.fixture(scope="session")
def bpe():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def pieces():
    return public_tokenizers.path("piece_bpe_32k.model")


DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, digest int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, extra columns with clashing names."""
    rows = [
        (1, "the same text here", "en", "a", 1, "x", 1),
        (2, "the  same\ntext here", "en", None, 1, "x", 1),
        (2, "the  same\ntext here", "en", None, 1, "x", 1),
        (3, "", "en", "b", 0, None, None),
        (4, None, None, None, None, None, None),
        (None, "the same text here", "de", "a", 1, "x", 1),
        (5, "mail me@x.org or call +1 (555) 010-2030, é 10.0.0.1", "fr", "b", 9, "y", 2),
        (6, "long " * 30_000 + "end", "en", "b", 9, "y", 2),
        (7, "\n \t", "en", "c", 3, "y", 2),
        (8, "one two three", "xx", "c", 3, "y", 2),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
