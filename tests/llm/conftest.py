import pytest

ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "One two three four five six seven."), (5, "one two THREE four five six seven."),
    (6, "short"), (7, "it's <|endoftext|> don't 'LL \u00c9t\u00e9 e\u0301t\u00e9 \u0130x \u65e5\u672c\u8a9e 42 \U0001f600"),
    (8, "a" * 3000), (9, "word " * 40_000), (10, "\n\n\nline one two three four five\n" * 3),
    (11, "the same words in one line of text here\nother"), (12, "the same words in one line of text here"),
    (12, "the same words in one line of text here"), (None, "the same words in one line of text here"), (None, None),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with further columns whose names clash with the operators' own."""
    rows = [(i, t, "x", 1, "y", 2, 3, "z") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score int, member string, n int, "
                                       "count int, predicted string").repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
