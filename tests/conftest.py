import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from verification.compare import connect, local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture(scope="session")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.fixture
def make(spark):
    """Small frame from rows and a schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def final_plan(frame) -> str:
    frame.write.format("noop").mode("overwrite").save()
    return frame._jdf.queryExecution().executedPlan().toString()
