import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from seqprep.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        4, **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": str(shared), "spark.driver.memory": "4g"}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def texts(spark):
    """id, text rows with the awkward cases."""
    rows = [
        (0, "the cat sat on the mat"),
        (1, "the dog"),
        (2, ""),
        (3, None),
        (4, "  the\tcat   the "),
        (5, "zebra unknown the"),
        (6, "!!! ..."),
    ]
    return spark.createDataFrame(rows, "id long, text string")
