import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def texts(spark, sf):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every awkward case: null and repeated ids, null, empty, blank and long
    texts, repeated rows, and columns named like the operators' own."""
    long = "Lorem ipsum dolor sit amet number%d here. " * 2000 % tuple(range(2000))
    rows = [(1, "", "en", 7), (2, None, "en", 7), (3, "   \n\t ", None, 7), (4, long, "en", 7), (None, "some text without id here", "en", 7),
            (5, "one word after another makes a text", "en", 7), (5, "one word after another makes a text", "en", 7),
            (5, "another text under the same id", "de", 7), (6, "one word after another makes a text", "de", 7), (7, "日本語 😀 12345 !!!", None, 7)]
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string, shard int")
            .selectExpr("*", "1 AS id", "2 AS th", "'x' AS fp", "3 AS pos", "4 AS n_lines"))
