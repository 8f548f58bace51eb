import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from edge_rows import EDGE_TEXTS  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with columns that operators use for
    their own ends."""

    def make(rows):
        full = [(*r, None, None)[:2] + ((*r, "en", "s")[2:4] if len(r) > 2 else ("en", "s")) + (7,) for r in rows]
        frame = spark.createDataFrame(full, DOCS)
        return frame.selectExpr(
            "*", "1 AS size", "'x' AS pos", "2 AS shard", "3 AS score", "4 AS block", "'k' AS key", "5 AS fp"
        )

    return make


@pytest.fixture
def edge(docs):
    return docs(EDGE_TEXTS)


@pytest.fixture
def empty(docs):
    return docs([])
