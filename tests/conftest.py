import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cohortwatch.session import get_spark
    s = get_spark("local[4]", app="cohortwatch-tests", shuffle_partitions=8,
                  extra={"spark.driver.memory": "6g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL
