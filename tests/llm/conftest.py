from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_cases import EDGE_ROWS, EDGE_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE_ROWS, EDGE_SCHEMA)


@pytest.fixture(scope="session")
def no_rows(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)
