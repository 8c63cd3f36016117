import pytest
from made_up import words


@pytest.fixture
def table(spark):
    """Rows with every hard case: nulls, empty and blank texts, repeats, a clash of names, one very long text."""
    def make(rows):
        schema = "doc_id bigint, text string, lang string, source string, id int, n int, label string, key string"
        return spark.createDataFrame([(*row, 1, 2, "x", None) for row in rows], schema)

    return make


@pytest.fixture
def odd_rows():
    long_text = " ".join(words(1, 30_000))
    plain = " ".join(words(2, 60))
    edited = " ".join([*words(2, 30), "changed", *words(2, 60)[31:]])
    return [
        (0, plain, "en", "a"),
        (1, plain, "en", "a"),
        (2, edited, "en", None),
        (3, None, None, "a"),
        (4, "", "en", "b"),
        (5, " \t\n", "de", "b"),
        (6, long_text, "de", "b"),
        (7, "one", "de", None),
        (None, plain, "en", "a"),
        (9, "ünï 漢字 \U0001f468‍\U0001f469  x\u0085y", None, "c"),
        (9, "ünï 漢字 \U0001f468‍\U0001f469  x\u0085y", None, "c"),
    ]
