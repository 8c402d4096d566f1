import pytest

from strandlake.session import ship

#: Texts that every operator must take: null, empty, no words, ties, repeats, very long, other scripts.
ODD = [None, "", " ", "!!!", "a", "The same text here, twice over.", "The same text here, twice over.", "x" * 30_000, "wort " * 20_000, "ÄÖ éà 漢字 \U0001f600 x", "a\x00b"]


@pytest.fixture
def odd(spark):
    """Odd texts with a null id, a repeated row and columns whose names clash with results."""
    ship(spark)
    rows = [(i, t, "en", 1.0, "k", 7) for i, t in enumerate(ODD)] + [(None, "null id", None, None, None, None), (5, ODD[5], "en", 1.0, "k", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, k1 string, n int")


@pytest.fixture
def none(spark):
    ship(spark)
    return spark.createDataFrame([], "doc_id long, text string, lang string")
