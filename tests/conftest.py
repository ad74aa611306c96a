import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from trawl.session import get_spark

    s = get_spark("local[4]", 4, app="trawl-tests")
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="trawl-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL
