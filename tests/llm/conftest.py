import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), os.path.dirname(os.path.abspath(__file__))]

from salesmart.config import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    yield local_session("*", shuffle_partitions=8, app="salesmart-llm-tests")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with a null id and text, empty and odd texts, repeated rows and columns whose names clash."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog. " * 40, "en", "src0", 5),
        (2, None, None, None, None),
        (3, "", "en", "src0", 0),
        (4, " \t\n ", "en", "src1", 4),
        (5, "one", "en", "src1", 3),
        (6, "The quick brown fox jumps over the lazy dog. " * 40, "en", "src0", 5),
        (6, "The quick brown fox jumps over the lazy dog. " * 40, "en", "src0", 5),
        (7, "x" * 30000, "de", "src2", 30000),
        (8, "ein zwei drei vier fünf  sechs sieben acht\x1cneun\n\n zehn 's <|endoftext|> 12345 ...", "de", "src2", 9),
        (None, "no id here", "en", "src3", 10),
        (9, "word " * 5000, "en", "src0", 25000),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, schema)
    for clash in ("start", "length", "ids", "hash", "n", "worker", "score", "words", "text_", "key"):
        df = df.selectExpr("*", f"'clash' AS {clash}")
    return df
