import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from riskspark.session import local_session

    s = local_session(cores=4, shuffle_partitions=8, app="riskspark-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    sys.path.insert(0, str(ROOT / "scripts"))
    from oracle_check import duck

    return duck(SMALL)
