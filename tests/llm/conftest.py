import pytest
from pyspark.sql import functions as F

LONG = "word " * 40_000 + "x" * 60_000


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and very long texts, repeats, ties, and columns whose names operators use."""
    rows = [
        (1, "one two three four", "a"), (2, None, "a"), (3, "", "b"), (4, " \t\n", None), (5, LONG, "b"), (6, "one two three four", "a"), (6, "one two three four", "a"),
        (7, "Ünï cödé 日本 😀 <|endoftext|> a  b\r\n", "c"), (8, "two words", None), (9, "two words", "c"), (10, "ONE TWO THREE FOUR", "c"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for name in ("size", "h", "bin", "copies", "id", "n", "rep", "print", "score", "features", "spans", "ids", "decoded", "host", "path", "key", "v", "target", "x", "a", "b", "root"):
        df = df.withColumn(name, F.lit("clash"))
    return df.withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
