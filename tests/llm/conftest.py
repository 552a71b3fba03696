import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpus_rows import EDGE, documents  # noqa: E402


@pytest.fixture(scope="session")
def edge(spark):
    return documents(spark, EDGE)


@pytest.fixture(scope="session")
def empty(spark):
    return documents(spark, [])
