import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfcast.session import get_spark  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="shelfcast-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
