import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lexweave.fixtures import Tables  # noqa: E402
from lexweave.session import local_session, scratch_path  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # Streams in the tests keep many small states; few partitions keep them quick.
    settings = {
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="lexweave-warehouse-"),
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="lexweave-test-"),
    }
    session = local_session("4", **settings)
    yield session
    session.stop()


@pytest.fixture
def tables(spark):
    return Tables(spark, SF)


@pytest.fixture
def scratch(spark):
    return lambda label="t": scratch_path(spark, label)


def rows(df):
    """Rows as sorted tuples, columns in frame order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
