import pytest

from postlake.llm.queries import prepare

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture(autouse=True)
def _prepared(spark):
    prepare(spark)


@pytest.fixture
def documents(spark):
    """A few awkward documents, or any rows given: nulls in every column, empty and long texts, rows
    that repeat, an id on several texts."""

    def make(rows=None):
        if rows is None:
            long = " ".join(f"wort{i % 977}" for i in range(40_000))
            rows = [
                (1, "The quick brown fox, it's here.\nThe quick brown fox.", "en", "a", 3), (1, "The quick brown fox, it's here.\nThe quick brown fox.", "en", "a", 3),
                (2, None, None, None, None), (None, "sin nombre  y\tsin id", "es", "b", 1), (None, None, None, None, None),
                (3, "", "de", "a", 0), (4, " \n\t ", "fr", "a", 4), (5, long, "de", "c", 9), (1, "another text under one id", "en", "a", 2),
                (6, "x" * 3000 + " " + "ab" * 800, "xx", "d", 1), (7, "naïve café — 東京 😀 ## <|endoftext|> a<|startoftext|>", "fr", "d", 1),
            ]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture
def clashing():
    """Columns that operators use themselves, on top of a table's own."""

    def add(frame):
        from pyspark.sql import functions as F

        names = ["n_tokens", "ids", "kept", "component_id", "fingerprint", "node", "topic", "score", "id", "text_hash", "rejected_by", "_n"]
        return frame.withColumns({name: F.lit("own") for name in names if name not in frame.columns})

    return add
