import pytest

LONG = "word " * 30_000


@pytest.fixture()
def docs(spark):
    """Rows of (doc_id, text); every other column of the result has a clashing name."""

    def build(rows):
        wide = [(i, t, "x", 1, True) for i, t in rows]
        return spark.createDataFrame(wide, "doc_id long, text string, component_id string, length int, kept boolean")

    return build
