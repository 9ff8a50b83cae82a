import pytest

HARD = [
    (1, None), (2, ""), (3, "  \t\n "), (4, "one"), (5, "two words"), (6, "Two Words"), (7, "two words"), (8, "x" * 200_000), (9, ("lorem ipsum dolor sit amet " * 8000)),
    (10, "ünïcödé 日本語 😀 text with \x00 control \x1c bytes"), (11, "a  b\n\n c \r\n"), (12, "don't I'LL <|endoftext|> stop"), (None, "a row without id"), (None, None), (14, "twice"), (14, "twice"), (14, "another text of one id"),
]


@pytest.fixture(scope="session")
def hard(spark):
    """Nulls, empty and very long texts, ties, repeated rows and ids, and columns with clashing names."""
    rows = [(i, t, "k", 1, 2.0, "x", 3) for i, t in HARD]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, part int, bucket double, _x0 string, n_chars long").repartition(3)


@pytest.fixture(scope="session")
def empty(hard):
    return hard.limit(0)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
