import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickstar.plans.warehouse import warehouse  # noqa: E402
from clickstar.session import build_session  # noqa: E402
from tests.compare import duck  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return build_session("tests", cores="*", partitions=2, **{"spark.default.parallelism": "2"})


@pytest.fixture(scope="session")
def w(spark):
    return warehouse(spark, SF_DIR)


@pytest.fixture(scope="session")
def con():
    return duck(SF_DIR)
