import pytest


@pytest.fixture
def docs(spark):
    """Documents as a table with the usual columns and one more."""

    def make(rows, extra="extra string"):
        more = ["x"] * (extra.count(",") + 1)
        full = [(i, t, "en", "src0", None if t is None else len(t), *more) for i, t in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {extra}")

    return make
