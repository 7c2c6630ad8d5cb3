import pytest

SMALL = "/root/testdata/sf0.001"
LONG = "the house of a loser and the garden in which it stands " * 2000

ODD_ROWS = [
    (5, None, None, None), (4, "", "en", "src0"), (3, " \n\t", "en", "src0"), (None, "the end of it", "en", None), (None, None, None, None),
    (7, "one two", "en", "src1"), (7, "one two", "en", "src1"), (8, "One  two", "en", "src1"), (9, LONG, "en", "src0"),
    (10, LONG + " tail", "en", "src0"), (11, "¡¿ 123 ?!", "es", "src2"), (-2, "日本語 🙂 <|endoftext|> </s>", None, "src2"),
]


@pytest.fixture(scope="session")
def small(spark):
    """Reads a small test table."""
    from adperf.llm.common import read

    return lambda name: read(spark, SMALL, name)


@pytest.fixture(scope="session")
def odd(spark, small):
    """Documents with NULLs, empty and very long texts, repeated rows and extra columns with the operators' own names."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(ODD_ROWS, "doc_id long, text string, lang string, source string")
    names = ("n_tokens", "score", "set_key", "id", "n", "target", "vector", "kept", "fits", "toxic", "component", "band", "weight")
    return docs.withColumns({c: F.lit("x") for c in names})
