import pytest


@pytest.fixture
def messy(spark):
    """Documents with nulls, empty, blank and long texts, repeated rows and clashing extra columns."""
    long_text = " ".join(f"word{i % 977} the of and" for i in range(4000))
    rows = [
        (1, "The cat and the dog.\nThe end of it.", "en", "a"), (2, None, None, None), (3, "", "en", "a"),
        (4, " \t\n ", "fr", "b"), (5, long_text, "en", "b"), (5, long_text, "en", "b"), (None, "une chose", None, "c"),
        (None, None, None, None), (6, "ééé 日本 🙂 <|endoftext|> x", "fr", "a"), (7, "The cat and the dog.\nThe end of it.", "en", None),
        (8, "a" * 70000, "de", "b"),
    ]
    return spark.createDataFrame(
        [(*r, "x", 1.5, "y") for r in rows],
        "doc_id long, text string, lang string, source string, _rid string, name double, level string")


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")
