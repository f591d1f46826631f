import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Builds a documents table of (doc_id, text) rows, with columns whose names operators use inside."""

    def make(*rows, extra="digest string, keep_id long, found string, `_key` string, `root` int, kept string, toxicity string"):
        n = len(extra.split(","))
        data = [(i, t, "en", "s", len(t or ""), *[None] * n) for i, t in rows]
        return spark.createDataFrame(data, f"{DOC}, {extra}")

    return make
