import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from epidw import registry  # noqa: E402
from epidw.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
EXPECTED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", 4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    """A completed load over the smallest tables."""
    load = registry.load_for(spark, SMALL)
    return registry._complete(load)


@pytest.fixture(scope="session")
def expected(spark):
    """A completed load at the scale for which the expected values were worked out."""
    return registry._complete(registry.load_for(spark, EXPECTED))


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]
