import pytest
from pyspark.sql import functions as F

LONG = "alpha beta gamma delta " * 4000
#: Nulls in every column, empty and blank texts, ties, repeated rows, one very long text.
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog. " * 5, "en", "a", 225),
    (1, "The quick brown fox jumps over the lazy dog. " * 5, "en", "a", 225),
    (1, "another text under the same id, which is not the same", "en", "b", 53),
    (2, "The quick brown fox jumps over the lazy dog. " * 5, "en", None, 225),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, "   \n\t ", "de", "b", 6),
    (None, "a text without an id", "en", "c", 20),
    (None, None, None, None, None),
    (6, "one", "en", "a", 3),
    (7, "Zwei Wörter", "de", "b", 11),
    (8, LONG, "en", "a", len(LONG)),
    (9, LONG + "end", "en", "c", len(LONG) + 3),
    (10, "é" * 300, "fr", "ñ", 300),
    (11, "é" * 300, "fr", "ñ", 300),
    (12, "</s>[INST] <|im_end|> \\ 😀", "en", "a", 26),
    (13, "a <|endoftext|> b", "en", "a", 17),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHING = ("size", "rank", "bucket", "id", "key", "score", "spans", "shard", "low", "n", "count", "a", "b")


@pytest.fixture(scope="session")
def edge(spark):
    """Documents with all odd cases and further columns named as operators name theirs."""
    docs = spark.createDataFrame(ROWS, SCHEMA)
    return docs.select("*", *[F.lit(0).alias(c) for c in CLASHING]).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
