import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2]))


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text[, source]) with extra columns of clashing names."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "s", 5, "x") for r in rows]
        return spark.createDataFrame(
            full, "doc_id bigint, text string, source string, size int, words string"
        )

    return make
