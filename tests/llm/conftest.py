import pytest


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with the operators' own."""

    def make(rows, extra=True):
        frame = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
        if extra:
            for name in ("id", "mark", "n", "rep", "h", "key", "digest", "content", "_keep", "kept", "size", "label"):
                frame = frame.selectExpr("*", f"'x' AS {name}")
        return frame

    return make
