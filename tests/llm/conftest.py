import pytest

#: Ids and texts with every awkward case: nulls, empty, blank, repeated rows, one id with two texts, no id, a long text.
AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one"),
    (4, "one"),
    (5, "two words"),
    (5, "other words"),
    (None, "no id"),
    (None, None),
    (6, "é ü 日本 <|endoftext|> \x00 \x1f"),
    (7, "word " * 20_000),
    (8, "x" * 50_000),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """The awkward rows with extra columns whose names the operators use themselves."""
    rows = [(i, t, "en", 0, "k", 1.5, "h") for i, t in AWKWARD]
    names = "doc_id long, text string, lang string, n_chars long, key string, score double, text_hash string"
    return spark.createDataFrame(rows, names).repartition(3)
