import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from odd_tables import odd_rows, write  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    """Folder with the awkward documents."""
    return write(spark, tmp_path_factory.mktemp("odd"), odd_rows())


@pytest.fixture(scope="session")
def odd_docs():
    return {row[0]: row[1] for row in odd_rows()}


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    folder = write(spark, tmp_path_factory.mktemp("empty"), [])
    return write(spark, folder, [], "vec_id long, embedding array<float>, label int", "embeddings")
