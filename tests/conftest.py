import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for p in (str(ROOT), str(ROOT / "tests")):
    if p not in sys.path:
        sys.path.insert(0, p)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sitelens.session import get_spark

    s = get_spark(master="local[4]", app="sitelens-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL
