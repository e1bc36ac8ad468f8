import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, blanks, a very long text, ties, repeated rows, null and repeated ids, and columns that clash with inner names."""
    same = "Der Hund läuft im Garten und bellt den Mond an weil er nicht schlafen kann heute Nacht"
    rows = [
        (1, same, "en", "a"),
        (1, same, "en", "a"),
        (2, None, None, None),
        (3, "", "en", ""),
        (4, " \n\t ", "de", "b"),
        (None, same, "en", "a"),
        (None, "something else entirely, with words of its own and nothing shared at all", None, None),
        (5, "x", "en", "b"),
        (6, "long " * 60_000 + "é" * 50_000, "en", "b"),
        (7, same + " ja", "en", None),
        (7, "the same id with another text\nand a second line", "en", "b"),
        (8, "\x00\x01 ￿ 😀 <|endoftext|> </s> mail a.b@example.com", "en", "b"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    clashing = ["size", "key", "slice", "same", "row", "words", "n", "items", "score", "set_key", "text_hash", "pii", "doc", "target", "copies", "digest"]
    return docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(clashing)))


@pytest.fixture(scope="session")
def no_documents(odd):
    return odd.limit(0)
