import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from textassay.runtime import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", cores=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """Rows (doc_id, text) from a list of texts."""

    def make(*values):
        return spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").repartition(3)

    return make


@pytest.fixture
def column_of(texts):
    """Values of an expression over ``text``, in the order of the given texts."""

    def evaluate(expression, *values):
        rows = texts(*values).select("doc_id", expression.alias("v")).collect()
        return [r["v"] for r in sorted(rows, key=lambda r: r["doc_id"])]

    return evaluate
