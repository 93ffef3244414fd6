import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adpulse.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("adpulse-tests", master="local[4]",
                  extra={"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g"})
    yield s
