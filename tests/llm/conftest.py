import pytest

TEXT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and long texts, ties and repeated rows, extra columns with clashing names."""
    long = " ".join(f"word{i % 977} {'und' if i % 5 else 'the'}" for i in range(40_000))
    rows = [
        (1, "alpha beta gamma delta epsilon zeta", "en", "s", 5), (1, "alpha beta gamma delta epsilon zeta", "en", "s", 5),
        (2, None, None, None, None), (None, "the house is near the old river and the mill", "en", None, 4), (None, None, None, None, None),
        (3, "", "fr", "s", 0), (4, "   \n\t ", "fr", "s", 6), (5, "12 34 !!", "de", "s", 8), (6, long, "en", "s", len(long)),
        (7, "é à ü  你好 🙂 naïve", None, "t", 1), (2**60 + 1, "x", "es", "t", 1), (8, 'say token = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b" now', "en", "t", 1),
    ]
    frame = spark.createDataFrame(rows, TEXT)
    return frame.selectExpr("*", "'x' as node", "1 as part", "2L as chunk", "lang as kept", "array(1) as ids", "3 as found_id")


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("false")
