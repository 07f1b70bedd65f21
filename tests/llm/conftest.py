import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_helpers import DOCS  # noqa: E402


@pytest.fixture
def documents(spark):
    def make(*texts, lang="en", source="s", ids=None):
        rows = [
            (ids[i] if ids else i, text, lang, source, None if text is None else len(text)) for i, text in enumerate(texts)
        ]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
