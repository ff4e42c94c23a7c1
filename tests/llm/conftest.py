import pytest


@pytest.fixture
def texts(spark):
    """A table of (doc_id, text) with columns whose names operators use inside."""

    def make(rows):
        data = [(i, t, "x", 1, 2, 3) for i, t in rows]
        return spark.createDataFrame(data, "doc_id long, text string, fp string, cell int, part int, address int")

    return make
