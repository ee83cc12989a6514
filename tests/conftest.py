import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tunedata.session import checkpoint_dir, get_spark
    # A run of the tests has one machine: a temporary folder is shared by all its workers.
    with tempfile.TemporaryDirectory(prefix="tunedata-tests-") as shared:
        s = get_spark("local[4]", app="tunedata-tests", shuffle_partitions=4, extra={"spark.checkpoint.dir": shared})
        checkpoint_dir(s)
        yield s
        s.stop()


@pytest.fixture
def scratch(spark):
    from tunedata.session import scratch_path
    return lambda name: scratch_path(spark, name)
