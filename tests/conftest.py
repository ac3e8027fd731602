import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderloom.session import local_session, remove_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "4g", 4)
    yield session
    remove_scratch(session)
    session.stop()


@pytest.fixture
def values(spark):
    """A frame of text columns: values('a b', ('1', None), ...)."""

    def make(names, *rows):
        return spark.createDataFrame(list(rows), ", ".join(f"{n} string" for n in names.split()))

    return make
