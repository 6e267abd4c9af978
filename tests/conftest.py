import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lexibid.sources.session import local_session  # noqa: E402

FIXTURES = Path(__file__).resolve().parent / "fixtures"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def fixture_path():
    return lambda name: str(FIXTURES / name)


@pytest.fixture(scope="session")
def texts(spark):
    """A table ``id, text`` of the given strings."""
    return lambda *values: spark.createDataFrame(list(enumerate(values)), "id int, text string")


@pytest.fixture(scope="session")
def values():
    """The sorted values of a one-column DataFrame."""
    return lambda df: sorted(row[0] for row in df.collect())


@pytest.fixture(scope="session")
def plan():
    """The physical plan as text."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
