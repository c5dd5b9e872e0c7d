import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pulsegrid.session import get_session
    from pulsegrid.streaming.ingest import use_rocksdb

    s = get_session(master="local[4]", shuffle_partitions=8,
                    extra={"spark.driver.memory": "8g", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1"})
    s.sparkContext.setLogLevel("ERROR")
    use_rocksdb(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="pg-test-", dir="/tmp")
