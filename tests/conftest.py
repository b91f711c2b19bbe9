import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from catchlake.fixtures import Tables  # noqa: E402
from catchlake.session import intermediates, local_session  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(shared=str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def no_leftovers(spark):
    """What a module's tests wrote to the shared folder goes when they are over."""
    with intermediates(spark):
        yield


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, FOLDER)
