import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from addrflow.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="addrflow-tests")
    yield s
    s.stop()


def one_col(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")
