import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="quarry-test-ckpt-")
    s = build_session(4, shuffle_partitions=4, app="quarry-tests",
                      extra={"spark.checkpoint.dir": ckpt, "spark.default.parallelism": "4"})
    yield s
    s.stop()
