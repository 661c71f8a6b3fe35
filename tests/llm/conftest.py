import pytest

LONG = "lorem ipsum dolor sit amet " * 8000


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in any column, empty and very long texts, repeated rows, columns with names used inside."""
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, LONG, "en", None, len(LONG)), (4, "one two", None, "a", 7), (4, "one two", None, "a", 7), (None, "mail me at bob@example.com", "en", "a", 26),
        (6, "   \n\t ", "en", "b", 6), (7, "naïve Café ÆØÅ 日本語 words", "en", "b", 24), (8, "x" * 50_000, "en", "b", 50_000),
    ]
    base = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = ["leak", "spans", "_p", "key", "rep", "n", "hits", "shard", "length", "_host", "band", "order", "x", "media", "component", "size"]
    return base.selectExpr("*", *[f"'junk' AS `{c}`" for c in extra])


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def few_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
