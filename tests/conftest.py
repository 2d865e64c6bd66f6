import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from dwellspark.session import build_session
    ckpt = tempfile.mkdtemp(prefix="dwellspark-test-ckpt-")
    s = build_session("local[4]", app_name="dwellspark-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from dwellspark.session import shared_path
    return shared_path(spark, "test")
