import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "scripts"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from trendlake.session import get_spark
    scratch = tempfile.mkdtemp(prefix="trendlake-tests-")
    extra = {"spark.local.dir": os.path.join(scratch, "local")}
    # Tests run in local mode: a private checkpoint folder, only when none is configured.
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        extra["spark.checkpoint.dir"] = os.path.join(scratch, "checkpoints")
    s = get_spark("local[4]", app="trendlake-tests", shuffle_partitions=8, extra=extra)
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
