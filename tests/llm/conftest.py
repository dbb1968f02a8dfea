import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from corpus_tables import BENCH, odd_documents, odd_pages, write_tables  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    labels = [(r[0], 1 if i % 3 else 0, 0) for i, r in enumerate(odd_documents())]
    return write_tables(spark, tmp_path_factory.mktemp("odd"), odd_documents(), odd_pages(), BENCH, labels)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    return write_tables(spark, tmp_path_factory.mktemp("empty"), [], [], [], [])
