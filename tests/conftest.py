import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from evidex.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="module", autouse=True)
def models_travel_by_value(request):
    """Workers cannot import test files, so that models defined there are sent with the task."""
    cloudpickle.register_pickle_by_value(request.module)
    yield
    cloudpickle.unregister_pickle_by_value(request.module)
