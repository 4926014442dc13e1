import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quiver.plans.session import build_session

    # no partition coalescing: tiny test data would otherwise collapse every
    # shuffle into one task and hide partitioning mistakes
    s = build_session("local[4]", app="quiver-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g",
                             "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    sc = s.sparkContext
    if not sc.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        # tests run locally: a temporary folder is the shared folder here
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quiver-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="quiver-test-")
