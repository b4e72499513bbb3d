import pytest
from pyspark.sql import functions as F

#: Nulls, empty and white-space texts, ties, repeated rows, a long text, other scripts.
ROWS = [
    (1, "One two three four five six seven eight nine ten"),
    (2, "one two three four five six seven eight nine ten"),
    (2, "one two three four five six seven eight nine ten"),
    (3, "one two three four five six seven eight nine  ten"),
    (4, None),
    (5, ""),
    (6, " \t\n"),
    (None, "nobody owns this line of text at all"),
    (None, None),
    (7, "日本語 текст ελληνικά 😀"),
    (8, "word " * 30_000),
    (9, "x" * 70_000),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="session")
def docs(spark):
    """Odd rows, with columns whose names operators use themselves."""
    rows = spark.createDataFrame(ROWS, SCHEMA)
    return rows.withColumns({c: F.lit("other") for c in ("kept", "_doc", "sid", "score", "key", "id", "line", "a")})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
