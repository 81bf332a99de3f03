import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ticksmith.session import local_session

    s = local_session("ticksmith-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def docs_df(spark):
    def make(pairs):
        return spark.createDataFrame(list(pairs), "doc_id string, body string")
    return make
