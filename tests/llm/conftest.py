import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, fp string, key string, count long, keep_id long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, ties and column names that operators use themselves."""
    one = "the same words appear in this text again and again so that twenty words in a row are surely found in it"
    texts = [None, "", "", " \n\t ", "a", "one two", one, one, one + " end", "start " + one, one.upper(), "é ü 日本 " * 5000, "x" * 30_000, "\n\n", "idiot worthless text"]
    rows = [(i, t, ("en", "de", None)[i % 3], ("b", "a", None, "c")[i % 4], 1, "i", None, "k", 2, 3) for i, t in enumerate(texts)]
    rows += [rows[6], (None, "no id", None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
