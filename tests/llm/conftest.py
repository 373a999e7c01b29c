import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_fixtures import awkward_rows, frame  # noqa: E402


@pytest.fixture(scope="session")
def rows():
    return awkward_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows, clashing=True).persist()


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])
