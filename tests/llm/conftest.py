import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Null and empty values, repeated ids and rows, long texts and columns whose names clash."""
    long_text = "\n".join(f"line number {i} of a very long text" for i in range(20_000))
    rows = [
        (1, "a shared line of text\nown line of one", "s", 1, "x"), (2, "A SHARED line of text \nown line of two", "s", 2, "x"),
        (3, None, None, 3, None), (4, "", "s", 4, "y"), (5, " \t\n", "t", 5, "y"), (None, "text without any id here", "t", 6, "z"),
        (6, long_text, "u", 7, "z"), (7, "one two three four five six seven", "u", 8, "z"),
        (7, "one two three four five six seven", "u", 8, "z"), (7, "another text of the same id", "u", 9, "z"),
        (8, "tiny", None, 10, "z"), (9, "é ß 漢字 \U0001f600 mixed", "t", None, "z")]
    schema = "doc_id long, text string, source string, kept long, node string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def empty(spark, odd):
    return spark.createDataFrame([], odd.schema)
